"""A tree of a page's blocks, tolerant of any markup."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Element names of HTML by the part they play.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: A start tag closes the nearest open one of these, unless a container stands between.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "body": ("head",),
}
_CONTAINERS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header html main nav ol section"
    " table tbody td tfoot th thead ul".split()
)

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)", re.S)
_PLAIN = re.compile(r"[^>\"']*+")
_CLASS = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)


#: Elements nested deeper are read as part of the one around them.
DEEPEST = 100


class Block:
    """An element that breaks the text, or (``tag`` "#text") a run of text in one."""

    __slots__ = ("tag", "names", "kids", "text", "linked")

    def __init__(self, tag: str, names: str = "", text: str = "", linked: int = 0):
        self.tag, self.names, self.text, self.linked = tag, names, text, linked
        self.kids: list[Block] = []

    @property
    def key(self) -> tuple[str, str]:
        return (self.tag, self.names)


def packed(block: Block) -> list:
    """A tree as plain lists, to be sent."""
    return [block.tag, block.names, block.text, block.linked, [packed(k) for k in block.kids]]


def unpacked(lists: list) -> Block:
    tag, names, text, linked, kids = lists
    block = Block(tag, names, text, linked)
    block.kids = [unpacked(k) for k in kids]
    return block


def _names(attributes: str) -> str:
    """Class, id and role, in lower case."""
    if "=" not in attributes:
        return ""
    return " ".join(unescape(m.strip("\"'")) for m in _CLASS.findall(attributes)).lower()


class _Builder:
    def __init__(self):
        self.root = Block("#root")
        self.open = [self.root]
        self.deeper: list[str] = []
        self.deeper_names: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.linked = self.links = 0

    def say(self, text: str) -> None:
        if text:
            self.pieces.append(text)
            if self.links:
                self.linked += len(text)

    def flush(self) -> None:
        """End a run of text."""
        if self.pieces:
            text = " ".join(unescape("".join(self.pieces)).split())
            if text:
                self.open[-1].kids.append(Block("#text", text=text, linked=self.linked))
            self.pieces, self.linked = [], 0

    def close(self, tags: tuple[str, ...]) -> None:
        """Close the nearest of these tags if it is open in the same container."""
        if self.deeper:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in tags:
                del self.open[depth:]
                return
            if tag in _CONTAINERS:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            self.links += tag == "a"
            return
        self.flush()
        if tag in EMPTY:
            return
        self.close(("p", "h1", "h2", "h3", "h4", "h5", "h6") if tag == "p" or tag in _CONTAINERS else ("p",))
        self.close(CLOSES.get(tag, ()))
        if len(self.open) > DEEPEST:
            self.deeper.append(tag)
            self.deeper_names[tag] += 1
            return
        block = Block(tag, _names(attributes))
        self.open[-1].kids.append(block)
        self.open.append(block)

    def end(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.links = max(0, self.links - 1)
            return
        self.flush()
        if self.deeper:
            if self.deeper_names[tag]:
                closed = None
                while closed != tag:
                    closed = self.deeper.pop()
                    self.deeper_names[closed] -= 1
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                self.links = 0
                return


def _tag_end(html: str, at: int, lost: set[str]) -> int:
    """The place of the > that ends a tag, or the end of the page.

    A quote that is never closed is no quote: the tag ends at the next >. Which quotes occur no more is kept in ``lost``,
    so that none is looked for twice.
    """
    while True:
        at = _PLAIN.match(html, at).end()
        if at == len(html) or html[at] == ">":
            return at
        quote = html[at]
        closing = -1 if quote in lost else html.find(quote, at + 1)
        if closing < 0:
            lost.add(quote)
        at = max(at, closing) + 1


def parse(html: str) -> Block:
    """The blocks of a page, texts with references decoded and white space made single."""
    page = _Builder()
    at = 0
    lost: set[str] = set()
    while (found := _TOKEN.search(html, at)) is not None:
        page.say(html[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        end = _tag_end(html, at, lost)
        attributes, at = html[at:end], end + 1
        if found[1]:
            page.end(tag)
            continue
        page.start(tag, attributes)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else len(html)
    page.say(html[at:])
    page.flush()
    return page.root

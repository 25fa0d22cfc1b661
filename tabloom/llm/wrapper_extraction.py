"""Main text of web pages by wrapper induction.

The different pages of a host are dealt in groups of about ``group`` by hash, so that a host with very many
pages is many groups; a page is read once, and its text joined to its copies. In a group every page's tree is
aligned with that of the first by simple tree matching, and what
finds no place there with the next page that has such slots: two
nodes match if their tags and classes do, and of their children as many as can in order,
counted by the nodes matched below them. Neighbouring blocks alike that hold nothing but text
(paragraphs, list items) are one slot, whatever their number. A slot that the group's pages fill
with the same text, or from a small stock of texts, is template on the pages that have such a text; the rest is
content, and so is the longest slot of an article. Pages that share their longest texts, up to three
quarters of the page, and the h1 are copies and one witness, and a group of few witnesses induces nothing.

Blocks that are boilerplate by their name or class (menus, forms, adverts, comments and so on)
go too, but names are evidence and no verdict: a block that holds the story, by an article or main element that lies
nowhere else, by most of the text that is no link or by the only h1, stays. Where a page has a main element the content is
there, or else in its articles.

Defined results: null or empty html gives an empty text, as does a page without content. A null url, or one
without a host, belongs to the host "". Pages that repeat a page_id are pages of their own. Any
markup is read, broken or not; pages are read whole. An empty table gives no rows. Columns other
than key, url and html play no part.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.llm.common import ship
from tabloom.llm.html_tree import RAW, Block, packed, parse, unpacked

# Elements without text of a page, elements that are mostly no content, and words of classes, ids and
# roles that mark what is no content or say nothing about it.
_NEVER = RAW | frozenset(
    "head noscript template svg math canvas object audio video button select datalist dialog".split()
)
_TAGS = frozenset("nav footer aside form menu".split())
_MARKS = frozenset(
    "ad ads advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment comments consent"
    " contentinfo cookie cookies copyright discussion disqus feedback footer gdpr login masthead menu menubar modal nav"
    " navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion rail related"
    " reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription"
    " teaser teasers toolbar topbar widget".split()
)
_READERS = frozenset("comment comments discussion disqus feedback replies reply respond".split())
_OUTSIDE = frozenset("header".split())
_NEUTRAL = frozenset(
    "area article bar block body bottom box btn button buttons col column container content desktop entry field form"
    " global group head icon icons inner item items js left link links list main mobile module outer page panel policy"
    " post posts primary region right row section secondary site stories text title top wrap wrapper zone".split()
)
_MAIN = ("article", "main")
#: Whether a block goes: never by its name, whatever stands around it, or outside the main block alone.
_STAYS, _GOES, _GOES_OUTSIDE = range(3)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre #text".split())
_WORD = re.compile(r"[a-z0-9]+")
#: Different pages in a group held at once, and pages a task remembers.
_HELD, _SEEN = 256, 100_000
#: Pages that share the longest texts up to this share of them are copies.
_MOST = 0.75
#: Children are matched in one table up to this size, longer lists between anchors.
_WIDE = 100_000


class Induction(NamedTuple):
    """When a slot is template: of at least so many different pages, by the share of one text or of different ones."""

    witnesses: int = 8
    same: float = 0.9
    stock: float = 0.5


def _flat(block: Block) -> bool:
    return all(k.tag == "#text" for k in block.kids)


class Slot:
    """A block, or neighbouring blocks alike that hold only text."""

    __slots__ = ("key", "blocks", "kids", "size", "mark")

    def __init__(self, block: Block):
        self.key, self.blocks = block.key, [block]
        self.mark = _mark(*block.key)
        self.kids: list[Slot] = []
        for kid in block.kids if not _flat(block) else ():
            last = self.kids[-1] if self.kids else None
            if last and last.key == kid.key and not last.kids and _flat(kid) and _flat(last.blocks[0]):
                last.blocks.append(kid)
            else:
                self.kids.append(Slot(kid))
        self.size = 1 + sum(k.size for k in self.kids)

    def text(self) -> str:
        return " ".join(_texts(self.blocks))

    def goes(self, in_main: bool) -> bool:
        return self.mark == _GOES or (self.mark == _GOES_OUTSIDE and not in_main)


def _texts(blocks: list[Block]) -> Iterator[str]:
    for block in blocks:
        if block.text:
            yield block.text
        yield from _texts(block.kids)


def _mark(tag: str, names: str) -> int:
    """What the name of a block and the words of its class, id and role say.

    A class counts as a whole: one that has a word of no meaning here, as ``has-sidebar`` or ``ad-free``, says nothing.
    """
    if tag in _NEVER or tag in _TAGS:
        return _GOES
    if tag in ("main", "body", "html"):
        return _STAYS
    found = _GOES_OUTSIDE if tag == "header" else _STAYS
    for name in names.split():
        words = set(_WORD.findall(name)) - _NEUTRAL
        if words and words <= _MARKS:
            return _GOES
        if words and words <= _OUTSIDE:
            found = _GOES_OUTSIDE
    return found


def read_page(tree: Block) -> Slot:
    """The slots of a page. Names are evidence and no verdict: what holds the story stays whatever it is called."""
    page = Slot(tree)
    while (wrapper := _wrapper(page)) is not None:
        wrapper.mark = _STAYS
    return page


def _wrapper(page: Slot) -> Slot | None:
    """The outermost block that goes by its name although the page's story is in it, if there is one.

    That is where an article or main element, or else the h1, lies nowhere but in blocks that go. The
    block must hold most of the text that is no link, or of its kind the page's only h1. Readers' comments beside an h1
    are no story.
    """
    found: dict[str, list[tuple[Slot, ...]]] = {"story": [], "h1": []}
    goes: list[Slot] = []
    stack = [(page, ())]
    whole = 0
    size: dict[int, int] = defaultdict(int)  # unlinked text in the outermost block that goes
    while stack:
        slot, above = stack.pop()
        if slot.key[0] in _NEVER:
            continue
        if slot.mark != _STAYS and not above:
            above = (slot,)
            goes.append(slot)
        if slot.key[0] in _MAIN and slot.mark == _STAYS:
            found["story"].append(above)
        elif slot.key[0] == "h1":
            found["h1"].append(above)
        if not slot.kids:
            own = sum(len(t.text) - t.linked for b in slot.blocks for t in _runs(b))
            whole += own
            for block in above:
                size[id(block)] += own
        stack += [(kid, above) for kid in slot.kids]
    if () in found["story"] or (not found["story"] and () in found["h1"]) or not goes:
        return None
    largest = max(goes, key=lambda slot: size[id(slot)])
    words = set(_WORD.findall(largest.key[1]))
    if 2 * size[id(largest)] > whole and not (found["h1"] and () in found["h1"] and words & _READERS):
        return largest
    titled = [above[0] for above in found["h1"] if above and above[0].mark == _GOES and above[0].key[0] not in _TAGS]
    return titled[0] if len(titled) == 1 == len(found["h1"]) else None


def match(a: Slot, b: Slot, known: dict[tuple[int, int], int]) -> int:
    """The most nodes of two trees that can be matched, parents and order kept."""
    if a.key != b.key:
        return 0
    if not a.kids or not b.kids:
        return 1
    pair = (id(a), id(b))
    if pair not in known:
        known[pair] = 1 + sum(match(x, y, known) for x, y in _paired(a.kids, b.kids, known))
    return known[pair]


def align(a: Slot, b: Slot, known: dict[tuple[int, int], int], into: dict[int, Slot]) -> None:
    """The slots of ``a`` that the best matching pairs with slots of ``b``: id to slot."""
    into[id(a)] = b
    for x, y in _paired(a.kids, b.kids, known):
        align(x, y, known, into)


def _paired(a: list[Slot], b: list[Slot], known: dict[tuple[int, int], int]) -> Iterator[tuple[Slot, Slot]]:
    """The pairs of the best matching of two lists, in any order."""
    if not a or not b:
        return
    if len(a) * len(b) > _WIDE:
        i = j = 0
        for k, m in [*_anchors(a, b), (len(a), len(b))]:
            if (k - i) * (m - j) < len(a) * len(b):
                yield from _paired(a[i:k], b[j:m], known)
            else:  # nothing to hold on to
                yield from ((x, y) for x, y in zip(a, b) if x.key == y.key)
            if k < len(a):
                yield a[k], b[m]
            i, j = k + 1, m + 1
        return
    best = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(best[-1][j + 1], row[j], best[-1][j] + match(x, y, known)))
        best.append(row)
    i, j = len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            yield a[i], b[j]


def _anchors(a: list[Slot], b: list[Slot]) -> list[tuple[int, int]]:
    """Places of slots found once in both lists, by key and text or by key alone, as many as keep their order."""
    for name in (lambda slot: (slot.key, slot.text()), lambda slot: slot.key):
        places: list[dict] = [defaultdict(list), defaultdict(list)]
        for slots, found in zip((a, b), places, strict=True):
            for k, slot in enumerate(slots):
                found[name(slot)].append(k)
        both = [(at[0], places[1][n][0]) for n, at in places[0].items() if len(at) == 1 and len(places[1].get(n, ())) == 1]
        if both:
            return _rising(both)
    return []


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, sorted by the first, in which the second rises too."""
    ends: list[int] = []  # the least last place of a chain of each length
    last: list[int] = []
    before: list[int] = []
    for n, (_, m) in enumerate(pairs):
        at = bisect_left(ends, m)
        before.append(last[at - 1] if at else -1)
        ends[at:at + 1] = [m]
        last[at:at + 1] = [n]
    chain, n = [], last[-1]
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def _leaves(slot: Slot) -> Iterator[Slot]:
    if not slot.kids:
        yield slot
    for kid in slot.kids:
        yield from _leaves(kid)


def _shown(slot: Slot, in_main: bool = False) -> Iterator[Slot]:
    """The leaves that are not boilerplate by name."""
    if not slot.goes(in_main):
        if not slot.kids:
            yield slot
        for kid in slot.kids:
            yield from _shown(kid, in_main)


def _parts(page: Slot) -> tuple[list[Slot], bool]:
    """Where the content is, and whether that is in main or article elements."""
    mains = list(_mains(page))
    return mains or [page], bool(mains)


def _witness(page: Slot) -> tuple[str, ...]:
    """What copies of a page share when their menus or adverts differ: the longest texts, up to most of it, and the h1."""
    parts, in_main = _parts(page)
    leaves = [(leaf.key[0], leaf.text()) for part in parts for leaf in _shown(part, in_main)]
    longest, size, whole = [], 0, sum(len(text) for _, text in leaves)
    for text in sorted((text for _, text in leaves), key=len, reverse=True):
        if size >= _MOST * whole:
            break
        longest.append(text)
        size += len(text)
    return (*longest, "", *(text for tag, text in leaves if tag == "h1"))


def template_slots(pages: list[Slot], how: Induction = Induction()) -> list[set[int]]:
    """For each page of a group the ids of its slots that are template: those it fills with a text of the template.

    Slots that find no place in the first page are judged against the first page that has such a slot, and so
    on, until fewer than ``how.witnesses`` different pages are left.
    """
    witness = [_witness(page) for page in pages]
    template: list[set[int]] = [set() for _ in pages]
    # slots that go by their name anyway need no judgement
    open_leaves = [{id(leaf): leaf for leaf in _shown(page, True) if any(_texts(leaf.blocks))} for page in pages]
    left = list(range(len(pages)))
    while len({witness[k] for k in left}) >= how.witnesses:
        first = pages[left[0]]
        matched: list[list[tuple[Slot, Slot]]] = []  # for each page its leaves and those of the first page
        filled: dict[int, dict[tuple[str, ...], str]] = defaultdict(dict)  # slot of the first page: one text of a witness
        shared: dict[int, dict[str, set[tuple[str, ...]]]] = defaultdict(lambda: defaultdict(set))  # and who has a text
        for k in left:
            pairs: dict[int, Slot] = {}
            if pages[k] is first:
                pairs = {id(s): s for s in _all(first)}
            else:
                align(pages[k], first, {}, pairs)
            found = [
                (leaf, home)
                for leaf in open_leaves[k].values()
                if (home := pairs.get(id(leaf))) is not None and not home.kids and id(home) in open_leaves[left[0]]
            ]
            matched.append(found)
            for leaf, home in found:
                text = leaf.text()
                filled[id(home)].setdefault(witness[k], text)
                shared[id(home)][text].add(witness[k])
        fixed: dict[int, set[str]] = {}
        for leaf in open_leaves[left[0]].values():
            n, texts = len(filled[id(leaf)]), shared[id(leaf)]
            if n >= how.witnesses:
                stock = leaf.key[0] not in _PROSE and len(set(filled[id(leaf)].values())) <= how.stock * n
                least = 2 if stock else how.same * n
                fixed[id(leaf)] = {text for text, who in texts.items() if len(who) >= least}
        for k, found in zip(left, matched, strict=True):
            template[k].update(id(leaf) for leaf, home in found if leaf.text() in fixed.get(id(home), ()))
            for leaf, home in found:
                if id(home) in fixed or pages[k] is first:
                    del open_leaves[k][id(leaf)]
        left = [k for k in left if open_leaves[k] and pages[k] is not first]
    return template


def _all(slot: Slot) -> Iterator[Slot]:
    yield slot
    for kid in slot.kids:
        yield from _all(kid)


def _mains(slot: Slot) -> Iterator[Slot]:
    """The outermost main and article elements that do not go."""
    if slot.goes(False):
        return
    if slot.key[0] in _MAIN:
        yield slot
    else:
        for kid in slot.kids:
            yield from _mains(kid)


def _content(slot: Slot, template: set[int], in_main: bool, in_story: bool) -> Iterator[str]:
    """The texts that stay; outside of the story a list of links is a menu."""
    if id(slot) in template and not slot.kids or slot.goes(in_main):
        return
    if slot.kids:
        for kid in slot.kids:
            yield from _content(kid, template, in_main, in_story or kid.key[0] == "article")
        return
    leaves = [t for b in slot.blocks for t in _runs(b)]
    linked, size = sum(t.linked for t in leaves), sum(len(t.text) for t in leaves)
    if not in_story and slot.key[0] in ("li", "div", "td") and linked > 0.8 * size:
        return
    yield from (t.text for t in leaves)


def _runs(block: Block) -> Iterator[Block]:
    """The runs of text in a block."""
    if block.tag == "#text":
        yield block
    for kid in block.kids:
        yield from _runs(kid)


def main_text(page: Slot, template: set[int]) -> str:
    parts, in_main = _parts(page)
    if in_main:  # the main block of an article is content whatever other pages hold
        template = template - {id(max((s for p in parts for s in _shown(p, True)), key=lambda s: len(s.text()), default=page))}
    found = []
    for part in parts:
        in_story = part.key[0] == "article" or (in_main and not any(s.key[0] == "article" for s in _all(part)))
        found += _content(part, template, in_main, in_story)
    return " ".join(found)


def _extract(pages: list[str], how: Induction) -> list[str]:
    return _extract_trees([parse(html) for html in pages], how)


def _extract_trees(pages: list[Block], how: Induction) -> list[str]:
    trees = [read_page(page) for page in pages]
    template = template_slots(trees, how) if len(trees) >= how.witnesses else [set()] * len(trees)
    return [main_text(tree, found) for tree, found in zip(trees, template, strict=True)]


def _sent_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their page's tree, compressed; of a page sent before, as far as this task knows, one more without it."""
    seen: dict[tuple[str, str], bool] = {}  # and whether it was told that there are copies
    packer = zstandard.ZstdCompressor(level=9)
    tree = lambda html: json.dumps(packed(parse(html)), ensure_ascii=False, separators=(",", ":"))
    for batch in batches:
        sent, trees = [], []
        pages = zip(*(batch[c].to_pylist() for c in ("host", "digest", "html")), strict=True)
        for at, (host, digest, html) in enumerate(pages):
            if len(seen) >= _SEEN:
                seen.clear()
            told = seen.get((host, digest))
            if not told:
                seen[host, digest] = told is not None
                sent.append(at)
                trees.append(packer.compress(tree(html).encode()) if told is None else None)
        if sent:
            columns = batch.take(pa.array(sent)).columns
            yield pa.RecordBatch.from_arrays([*columns[:-1], pa.array(trees, pa.binary())], [*batch.schema.names[:-1], "tree"])


def _extract_groups(batches: Iterator[pa.RecordBatch], how: Induction) -> Iterator[pa.RecordBatch]:
    """(host, digest, id, url, text, copied) of each page once, out of rows sorted by group and digest, those
    with the page first. The pages of a group are held together, and rows of a page are few for each task that sent them.
    """
    group: tuple | None = None
    held: dict[str, list] = {}  # digest: tree, id, url, whether there are more rows

    def done() -> pa.RecordBatch:
        trees, ids, urls, copied = zip(*held.values(), strict=True)
        values = [[group[0]] * len(held), list(held), ids, urls, _extract_trees(list(trees), how), copied]
        held.clear()
        kinds = [pa.string(), pa.string(), kind, pa.string(), pa.string(), pa.bool_()]
        columns = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["host", "digest", "id", "url", "text", "copied"])

    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        kind = batch["id"].type
        for host, part, digest, key, url, tree in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (host, part) == group and digest in held:
                held[digest][3] = True
                continue
            if held and ((host, part) != group or len(held) >= _HELD):
                yield done()
            group = (host, part)
            held[digest] = [unpacked(json.loads(unpacker.decompress(tree))), key, url, False]
    if held:
        yield done()


def host_of(url: Column | str) -> Column:
    """The host of a url in lower case, without user or port; "" if there is none."""
    name = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(name, F.lit("")))


def extract_main_text(
    pages: DataFrame,
    how: Induction = Induction(),
    group: int = 64,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``key``, ``url`` and the main text of every page."""
    ship(pages.sparkSession)
    whole = pages.select(
        host_of(url).alias("host"), F.col(key).alias("id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html")
    ).withColumn("digest", F.md5("html"))
    rows = written(whole.drop("html"), "page-rows")
    # hosts of more different pages than a group are dealt over several; Spark decides by its size how this list is joined
    large = written(
        rows.select("host", "digest")
        .distinct()
        .groupBy("host")
        .count()
        .where(F.col("count") > group)
        .select("host", F.ceil(F.col("count") / group).alias("parts")),
        "large-hosts",
    )
    part = F.pmod(F.xxhash64("digest"), F.coalesce("parts", F.lit(1))).alias("part")
    dealt = whole.join(large, "host", "left").select("host", part, "digest", "id", "url", "html")
    kind = pages.schema[key].dataType.simpleString()
    row = f"host string, part bigint, digest string, id {kind}, url string"
    texts = written(
        dealt.mapInArrow(_sent_once, f"{row}, tree binary")
        .repartition("host", "part")
        .sortWithinPartitions("host", "part", "digest", F.col("tree").isNull())
        .mapInArrow(
            lambda batches: _extract_groups(batches, how),
            f"host string, digest string, id {kind}, url string, text string, copied boolean",
        ),
        "page-texts",
        compression="zstd",
    )
    # both sides are stored, so adaptive execution splits a page with very many copies
    copied = texts.where("copied").select("host", "digest", "text")
    copies = rows.join(copied, ["host", "digest"]).select("id", "url", "text")
    found = texts.where("not copied").select("id", "url", "text").unionByName(copies)
    return found.withColumnsRenamed({"id": key, "url": url})

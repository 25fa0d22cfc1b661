import re
import time
from collections import Counter
from html import unescape

import pyarrow as pa
import pytest

from tabloom.llm import wrapper_extraction as w
from tabloom.llm.html_tree import parse


def page(k, extra=""):
    return f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use</div><ul class=menu><li><a href=/>Home</a><li><a href=/a>A</a></ul>
<div class=content><h1>Title {k}</h1><p>Body of &eacute; {k} a<b>bc</b>d<p>More &amp; more {k}{extra}
<div class="tagline">Follow us</div></div><div id=sidebar>side</div><section class="comments"><p>nice {k}</section>
<form><label>Name</label><textarea>x</textarea></form><script>if (a < b) "</p>"</script><footer>c</footer></body></html>"""


def wanted(k, extra=""):
    return f"Title {k} Body of é {k} abcd More & more {k}{extra}"


def test_constant_slots_are_template():
    pages = [page(k) for k in range(10)]
    assert w._extract(pages, w.Induction()) == [wanted(k) for k in range(10)]


def test_few_pages_induce_nothing():
    assert w._extract([page(1), page(2)], w.Induction()) == [wanted(k) + " Follow us" for k in (1, 2)]


def test_copies_are_one_witness():
    assert w._extract([page(1)] * 20, w.Induction()) == [wanted(1) + " Follow us"] * 20


@pytest.mark.parametrize("tag", ["article", "div class=content", "section"])
@pytest.mark.parametrize("body", ["p", "div"])
def test_copies_under_differing_adverts_lose_nothing(tag, body):
    def story(k, advert):
        text = f"A story of its own, number {k}, told at some length."
        end = tag.split()[0]
        return f"<ul><li>Buy {advert}</ul><{tag}><h1>Title {k}</h1><{body}>{text}</{body}></{end}>", f"Title {k} {text}"

    pages = [story(0, k) for k in range(60)] + [story(k, k % 3) for k in range(1, 5)]
    got = w._extract([html for html, _ in pages], w.Induction())
    assert all(text in found for found, (_, text) in zip(got, pages, strict=True))


def test_a_text_of_its_own_in_a_template_slot_stays():
    pages = [page(k).replace("Follow us", f"Only here {k}" if k < 3 else "Follow us") for k in range(40)]
    got = w._extract(pages, w.Induction())
    assert got == [wanted(k) + (f" Only here {k}" if k < 3 else "") for k in range(40)]


@pytest.mark.parametrize("odd", ["", "<p>Nothing here", "<section><h2>An odd page</h2></section>"])
def test_every_layout_of_a_host_is_induced(odd):
    other = "<section><div class=top>All our shops</div><h1>Shop {0}</h1><p>Where shop {0} is.</p><div class=end>Come in</div></section>"
    pages = [odd] + [page(k) if k % 2 else other.format(k) for k in range(40)]
    got = w._extract(pages, w.Induction())
    assert got[1:] == [wanted(k) if k % 2 else f"Shop {k} Where shop {k} is." for k in range(40)]


def wide(k, n):
    items = [f"<div><h2>Head {k}.{i}</h2><p>Item {k}.{i} here</p></div>" for i in range(n)]
    fixed = [f"<div><h2>Shop {i}</h2><p>All about shop {i}</p></div>" for i in range(n)]
    new = "<div><h2>New</h2><p>Only on {0}</p></div>".format(k) * (k % 3 if n > 160 else 0)  # in the longest lists
    return "<body>" + new + "".join(f + x for f, x in zip(fixed, items)) + "</body>"


@pytest.mark.parametrize("n", [20, 40, 200])
def test_slots_are_judged_apart_at_every_width(n):
    got = w._extract([wide(k, n) for k in range(10)], w.Induction())
    for k, text in enumerate(got):
        assert "All about shop" not in text and all(f"Item {k}.{i} here" in text for i in range(n))


def test_links_beside_many_texts():
    links = "".join(f"<div><a href=/{i}>A longer name of page {i}</a></div><p>Text {i}</p>" for i in range(50))
    assert w._extract([links], w.Induction()) == [" ".join(f"Text {i}" for i in range(50))]


def brute_match(a, b):
    if a.key != b.key:
        return 0
    table = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i in range(len(a.kids)):
        for j in range(len(b.kids)):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + brute_match(a.kids[i], b.kids[j]))
    return 1 + table[-1][-1]


def test_tree_matching():
    a = w.Slot(parse("<div><h1>a</h1><ul><li>x</ul><p>b</p><div class=c><p>d</div></div>"))
    b = w.Slot(parse("<div><div class=c><h2>q</h2><p>d</div><h1>a</h1><p>b</p><div class=c><p>e</div></div>"))
    assert w.match(a, b, {}) == brute_match(a, b) > 3
    pairs = {}
    w.align(a, b, {}, pairs)
    assert len(pairs) == brute_match(a, b)


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("<", "<"),
        ("a &lt; b", "a < b"),
        ("<p>a<p>b<td>c</table></p>d", "a b c d"),
        ("<div>" * 3000 + "x" + "</div>" * 3000, "x"),
        ("<!-- x", ""),
        ("<p>a<br>b</p>", "a b"),
        ("<p>a&nbsp;&#8212;\n b</p>", "a — b"),
        ("<article><header><h1>T</h1></header><p>x</p><aside>no</aside></article><p>outside</p>", "T x"),
        ("<p title='a > b'>c</p>", "c"),
    ],
)
def test_markup(html, text):
    assert w._extract([html], w.Induction()) == [text]


def test_pages_against_their_articles(spark):
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = w.extract_main_text(pages).collect()
    assert len(got) == len(html)
    for r in got:
        article = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?[ab]>", "", article))
        assert r.text == " ".join(unescape(plain).split())


def test_large_hosts_are_many_groups(spark):
    rows = [(k, f"http://Big.example:80/{k}", page(k), "x") for k in range(200)] + [(None, None, None, "y"), (7, "", "<p>z", "y")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string").repartition(4)
    got = w.extract_main_text(df, group=32)
    assert got.columns == ["page_id", "url", "text"]
    texts = {(r.page_id, r.url): r.text for r in got.collect()}
    assert len(texts) == 202 and texts[(None, None)] == "" and texts[(7, "")] == "z"
    assert all(texts[(k, f"http://Big.example:80/{k}")] == wanted(k) for k in range(200))
    assert w.extract_main_text(df.where("false")).count() == 0


def test_a_host_swamped_by_copies_is_induced(spark):
    rows = [(k, f"http://big.example/{k}", page(k if k < 100 else 100)) for k in range(3_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6)
    got = w.extract_main_text(df).collect()
    assert sorted((r.page_id, r.url, r.text) for r in got) == [(k, url, wanted(min(k, 100))) for k, url, _ in rows]


def test_copies_are_sent_and_read_once(monkeypatch):
    """A task sends a page once, and one more row to say that there are copies."""
    monkeypatch.setattr(w, "_HELD", 4)
    names = ["host", "part", "digest", "id", "url", "html"]
    rows = [("h", k % 9 % 2, str(k % 9), k, None, f"<p>{k % 9}") for k in range(90)]
    rows += [("h", 0, "z", 90, "u", "<p>z"), ("i", 0, "x", 91, "u", "<p>x")]
    kinds = pa.schema(zip(names, [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]))
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)
    sent = list(w._sent_once([batch]))
    assert sent[0].num_rows == 9 * 2 + 2 and sent[0]["tree"].null_count == 9
    order = sorted(sent[0].to_pylist() * 2, key=lambda r: (r["host"], r["part"], r["digest"], r["tree"] is None))
    out = list(w._extract_groups([pa.RecordBatch.from_pylist(order, sent[0].schema)], w.Induction()))
    found = {(r["host"], r["digest"]): (r["text"], r["copied"]) for b in out for r in b.to_pylist()}
    assert found == {("h", str(k)): (str(k), True) for k in range(9)} | {("h", "z"): ("z", True), ("i", "x"): ("x", True)}
    once = [r for r in sorted(sent[0].to_pylist(), key=lambda r: (r["host"], r["part"], r["digest"], r["tree"] is None))]
    out = list(w._extract_groups([pa.RecordBatch.from_pylist(once, sent[0].schema)], w.Induction()))
    rows = [r for b in out for r in b.to_pylist()]
    assert len(rows) == 11 and {r["digest"] for r in rows if not r["copied"]} == {"z", "x"}


def test_empty_pages_on_a_third_of_all_rows(spark):
    rows = [(k, None if k % 3 else "", None if k % 2 else "") for k in range(3_000)] + [(k, "http://a.example", "<p>z") for k in range(3)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    got = w.extract_main_text(df).collect()
    assert sorted((r.page_id, r.url or "", r.text) for r in got) == sorted((k, u or "", "z" if h == "<p>z" else "") for k, u, h in rows)


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div class='content has-sidebar'><p>The whole article text.</p></div>", "The whole article text."),
        ("<div class='layout nav-left'><p>The whole article text.</p><div class=nav>Menu</div></div>", "The whole article text."),
        ("<main><p>Intro of main.</p><article><p>Art</p></article><p>More main.</p></main>", "Intro of main. Art More main."),
        ("<main><article><p>Art</p></article><div><a>More to read</a></div></main>", "Art"),
        ("<article><p>The story itself</p></article><article class=teaser><p>Other</p></article>", "The story itself"),
        ("<form id=page><nav>Menu</nav><div><h1>T</h1><p>Text of a page in a form</p></div></form>", "T Text of a page in a form"),
        ("<h1>Logo</h1><div class=nav-left><article><p>Long text of the story</p></article></div>", "Long text of the story"),
        ("<h1>T</h1><p>Short.</p><section class=comments><article><p>A very long comment</p></article></section>", "T Short."),
        ("<div class=sidebar><div><h1>T</h1><p>Long text</p><div class=comments>no, far longer</div></div></div>", "T Long text"),
        ("<div class=banner><h1>Title</h1></div><p>A text that is longer than the title</p>", "Title A text that is longer than the title"),
        ("<div class=ad>Buy</div><div class=ad-free><p>The text of the page</p></div>", "The text of the page"),
        ("<article class='post'><div class='article-footer'>x</div><div class=share-buttons>y</div><p>z</p></article>", "z"),
    ],
)
def test_names_are_no_verdict(html, text):
    assert " ".join(w._extract([html], w.Induction())) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ('<p title="x>Hello</p>', "Hello"),
        ("<p title='x>Hello</p><b class=\"y\">z</b>", "Hello z"),
        ("<a href='x' title=\"a > b\">c</a>", "c"),
        ("<p a=', b=\"'>x</p>\"y>z", "x \"y>z"),
        ("<p", ""),
    ],
)
def test_broken_quotes(html, text):
    assert w._extract([html], w.Induction()) == [text]


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<div>" * n + "x" + "</p>" * n,
        lambda n: "<a " * n + "'",
        lambda n: "<a href=\"" * n,
        lambda n: "<div>" * n + "x" + "</div>" * n,
        lambda n: "<p title='>a" * n + '"',
        lambda n: "<!--" * n + "<script>" * n,
    ],
)
def test_broken_markup_takes_linear_time(make):
    def seconds(n):
        html, start = make(n), time.process_time()
        w._extract([html], w.Induction())
        return time.process_time() - start

    seconds(100)
    assert seconds(40_000) < 14 * max(seconds(4_000), 0.02)


def bare(html):
    """A page without what its names tell: the article and every other part is a div, and no part has a class."""
    html = re.sub(r"<(/?)(?:article|main|nav|aside|footer|header|form|section)(?=[\s>])", r"<\1div", html)
    html = re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", html)
    return html.replace("<body>", "<body><div>All of our daily news in one letter</div>")


def test_pages_without_telling_names_by_induction_alone(spark):
    """Words of the article found, and words found that are the article's, where only the alignment of pages can tell.

    What is left over are adverts and footers, whose texts differ on every page; the line that all pages share goes.
    """
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(800)
    whole = {r.page_id: r.text for r in w.extract_main_text(rows).collect()}
    pages = spark.createDataFrame([(r.page_id, r.url, bare(r.html or "")) for r in rows.collect()], rows.schema)
    got = {r.page_id: r.text for r in w.extract_main_text(pages).collect()}
    none = {r.page_id: r.text for r in w.extract_main_text(pages, w.Induction(witnesses=10**9)).collect()}

    def measured(found):
        common = sum((Counter(found[k].split()) & Counter(whole[k].split())).total() for k in whole)
        return common / sum(len(t.split()) for t in whole.values()), common / sum(len(t.split()) for t in found.values())

    recall, precision = measured(got)
    print(f"induction alone: recall {recall:.3f}, precision {precision:.3f}")
    assert recall > 0.99 and precision > 0.94
    assert precision > measured(none)[1]
    letter = "All of our daily news in one letter"
    assert all(letter in t for t in none.values())
    host = {r.page_id: re.search("//([^/]*)", r.url or "//")[1].lower() for r in rows.collect()}
    pages_of = Counter(host.values())
    assert not [k for k, t in got.items() if letter in t and pages_of[host[k]] >= 16]

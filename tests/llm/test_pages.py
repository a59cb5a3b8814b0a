"""HTML extraction: fixtures by rule, and line alignment against a plain version."""

import random

import llm_cases as cases
import pytest

from tradewind.llm import pages, queries

SCHEMA = "page_id long, url string, html string"


def extracted(spark, *rows):
    found = pages.main_texts(spark.createDataFrame(list(rows), SCHEMA))
    return {r.page_id: r.text for r in found.collect()}


def one(html):
    lines = pages.lines_of(html)
    article = any(k in (pages.PROSE, pages.BLOCK) for k, _ in lines)
    wanted = (pages.PROSE, pages.BLOCK) if article else (pages.LOOSE,)
    return " ".join(t for k, t in lines if k in wanted)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var t="</p><article>no</article>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies</p></div><!-- <p>no</p> --><div class="ad">Buy</div>
<article><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>&nbsp;text.<br>Next
  line<p>Unclosed <i>one<p>A<em>B</em>C &lt;tag&gt; &#233;&#x65E5;</p><ul><li>x</li><li>y</li></ul>
<div class="share"><a href="#">Share</a></div><form><input><button>Go</button></form>
<aside>Side</aside><p class="advert">Ad</p><pre>a
  b</pre><section id="comments"><p>Nice!</p></section></article>
<footer>&copy; me</footer><div id="sidebar">Side <p>more</p></div></body></html>"""


def test_page_furniture_goes():
    assert one(PAGE) == "Title & more First bold text. Next line Unclosed one ABC <tag> é日 x y a b"


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("just text & more", "just text & more"),
        ("<p>a<p>b", "a b"),
        ("<article><p>cut off <b>her", "cut off her"),
        ("<article><p>a</p><script>never closed <p>b", "a"),
        ("<article><p>one</article><p>after</p>", "one"),
        ("<main><div>block</div></main>", "block"),
        ('<div role="main"><p>m</p></div><p>o</p>', "m"),
        ("<nav><ul><li>menu<article><p>open menu</p></article>", "open menu"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ('<article><p title="a>b">t</p></article>', "t"),
        ("<ARTICLE><P>UPPER</P></ARTICLE>", "UPPER"),
        ("<article><p>a</p><p hidden>h</p></article>", "a"),
        ("<article><p>&am &amp &quo &nope; &#0;</p></article>", "&am & &quo &nope; �"),
        ("<article><table><tr><td>1<td>2</table></article>", "1 2"),
    ],
)
def test_small_pages(html, text):
    assert one(html) == text


def test_shared_lines_go_and_prose_stays(spark):
    loose = lambda i, *own: "".join(f"<div>{t}</div>" for t in ("Top line", *own, "Bottom line"))
    article = lambda *own: (
        "<article><div>Read also: offers</div>" + "".join(f"<p>{t}</p>" for t in own) + "</article>"
    )
    got = extracted(
        spark,
        (1, "http://h/a/1", loose(1, "alpha", "beta")),
        (2, "http://h/a/2", loose(2, "gamma")),
        (3, "http://other/a/1", loose(3, "alone")),
        (4, "https://k/x/1", article("shared sentence", "mine")),
        (5, "https://k/x/2", article("shared sentence", "yours")),
        (6, "http://copy/1", loose(6, "copied")),
        (7, "http://copy/2", loose(6, "copied")),
        (8, None, None),
        (9, "http://h/a/3", ""),
        (10, "http://[bad", "<p>odd url</p>"),
    )
    assert got[1] == "alpha beta" and got[2] == "gamma"
    assert got[3] == "Top line alone Bottom line"
    assert got[4] == "shared sentence mine" and got[5] == "shared sentence yours"
    # Copies share everything, so they say nothing about each other.
    assert got[6] == got[7] == "Top line copied Bottom line"
    assert got[8] == got[9] == "" and got[10] == "odd url"


def test_nearest_paths_are_the_partners(spark, monkeypatch):
    def page(*lines):
        return "".join(f"<div>{line}</div>" for line in lines)

    rows = [
        (1, "http://h/news/a", page("news head", "one")),
        (2, "http://h/news/b", page("news head", "two")),
        (3, "http://h/shop/c", page("shop head", "two")),
        (4, "http://h/shop/d", page("shop head", "four")),
    ]
    got = extracted(spark, *rows)
    # One of three partners has the line: another version of a text would have most.
    assert got == {1: "news head one", 2: "news head two", 3: "shop head two", 4: "shop head four"}
    monkeypatch.setattr(pages, "VOTES", 1)
    assert extracted(spark, *rows) == {1: "one", 2: "", 3: "", 4: "four"}
    monkeypatch.setattr(pages, "PARTNERS", 1)
    # Page 2 is nearer to 1 than to 3, whose second line it has.
    assert extracted(spark, *rows) == {1: "one", 2: "two", 3: "two", 4: "four"}


def plain_partners(rows, at):
    """Over a whole host: every page sorted, then as the docstring says."""
    host = lambda i: rows[i][1].split("/")[2]
    path = lambda i: rows[i][1].split(host(i), 1)[1]
    lines = {i: rows[i][2] for i in range(len(rows))}
    same = sorted((i for i in range(len(rows)) if host(i) == host(at)), key=lambda i: (path(i), i))
    different, seen = [], set()
    for i in same:
        if lines[i] not in seen:
            seen.add(lines[i])
            different.append(i)
    own = next(i for i in different if lines[i] == lines[at])
    place = different.index(own)
    near = different[max(0, place - pages.REACH) : place] + different[place + 1 : place + 1 + pages.REACH]
    agree = lambda i: len(__import__("os").path.commonprefix([path(i), path(own)]))
    return sorted(near, key=lambda i: (-agree(i), abs(different.index(i) - place), different.index(i)))[: pages.PARTNERS]


@pytest.mark.parametrize("block_pages", [64, 9])
def test_partners_over_a_host_equal_plain_version(spark, monkeypatch, block_pages):
    """Hundreds of pages of three hosts with many copies; lines go if one of the partners has them."""
    for name, value in (("BLOCK_PAGES", block_pages), ("REACH", 12), ("PARTNERS", 7)):
        monkeypatch.setattr(pages, name, value)
    pick, rows = random.Random(5), []
    for i in range(220):
        path = f"/{pick.choice(['news', 'shop', 'x'])}/{pick.randrange(60)}/{pick.choice('abc')}{i:03d}"
        lines = [f"top {pick.randrange(3)}", f"own {pick.randrange(150)}", f"end {pick.randrange(4)}"]
        rows.append((i, f"http://h{i % 3}{path}", "".join(f"<div>{t}</div>" for t in lines)))
    rows += [(500 + i, f"{rows[i % 7][1]}?copy={i}", rows[i % 7][2]) for i in range(60)]
    got = extracted(spark, *rows)
    texts = lambda i: [t for _, t in pages.lines_of(rows[i][2])]
    for at, (page_id, *_) in enumerate(rows):
        own, near = texts(at), plain_partners(rows, at)
        found = [i for other in near for i in pages.common_lines(own, texts(other))]
        left = [t for i, t in enumerate(own) if found.count(i) < max(1, min(2, len(near)))]
        assert got[page_id] == " ".join(left), rows[at]


def test_copies_share_one_text(spark):
    """Groups of copies, all but the outer two between copies, beside other pages of the host."""
    page = lambda own: f"<div>menu</div><div>{own}</div><div>foot</div>"
    rows = [(i, f"http://h/p?page={i}", page("copied")) for i in range(30)]
    rows += [(100, "http://h/a", page("first")), (101, "http://h/z", page("last"))]
    got = extracted(spark, *rows)
    assert {got[i] for i in range(30)} == {"copied"} and got[100] == "first" and got[101] == "last"


def test_differencing_removes_furniture_first(spark):
    """Of the given pages a share of the furniture goes before layout is asked, and no prose."""
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    counts = {r.kind: (r.lines, r.shared) for r in pages.removed_lines(given).collect()}
    lines, shared = counts["furniture"]
    assert shared > 0.05 * lines and counts["prose"][1] == 0


def plain_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


@pytest.mark.parametrize("cells", [1 << 28, 50])
def test_common_lines(monkeypatch, cells):
    monkeypatch.setattr(pages, "TRACE_CELLS", cells)
    pick = random.Random(1)
    for _ in range(300):
        a = [pick.randrange(6) for _ in range(pick.randrange(25))]
        b = [pick.randrange(6) for _ in range(pick.randrange(25))]
        found = pages.common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == plain_length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_very_long_pages():
    a = [i % 997 for i in range(30_000)]
    assert len(pages.common_lines(a, a[::-1])) > 0
    html = "<article>" + "<p>line &amp; text</p>" * 20_000 + "</article>"
    assert one(html).count("line & text") == 20_000
    deep = "<article>" + "<div>x<span class=ad>y" * 20_000
    assert one(deep).startswith("x")


def test_query_on_given_pages(spark):
    """Every page of the given table has one article; its text is all that stays."""
    import html
    import re

    folder = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inner = re.search("(?s)<article>(.*)</article>", r.html)[1]
        text = " ".join(html.unescape(re.sub("</?(b|i)>", "", re.sub("</?(h1|p|br)>", " ", inner))).split())
        want.append((r.page_id, r.url, text, len(text)))
    got = queries.op3_nearest_url(spark, folder)
    assert cases.tuples(got, "page_id", "url", "text", "n_chars") == sorted(want, key=repr)


def test_repeated_rows_empty_table_and_clashing_columns(spark):
    rows = [(1, "http://h/1", "<p>a</p><p>b</p>")] * 3 + [(2, "http://h/2", "<p>a</p><p>c</p>")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS text", "1 AS host", "2 AS lines")
    assert cases.tuples(pages.main_texts(df), "page_id", "text") == [(1, "b")] * 3 + [(2, "c")]
    assert pages.main_texts(spark.createDataFrame([], SCHEMA)).collect() == []

import random
from functools import lru_cache

import pytest

from orderlens.llm import html_text as H

SF = "/root/testdata/sf0.001"


def lcs(a, b):
    @lru_cache(None)
    def f(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + f(i + 1, j + 1) if a[i] == b[j] else max(f(i + 1, j), f(i, j + 1))
    return f(0, 0)


def test_longest_common_subsequence():
    rnd = random.Random(5)
    for _ in range(400):
        a = [rnd.choice("abcde") for _ in range(rnd.randint(0, 14))]
        b = [rnd.choice("abcdx") for _ in range(rnd.randint(0, 14))]
        got = sorted(H.shared_lines(a, b))
        assert len(got) == lcs(tuple(a), tuple(b))
        it = iter(b)
        assert all(a[i] in it for i in got)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script><style>p{}</style></head><body>
<header>Site</header><nav><ul><li>Home</ul></nav><div class="ad-box">Buy</div><div id="cookieNotice">Cookies</div>
<article><header><h1>Title &amp; more</h1></header><p><b>First
   line.<br><p>Second&nbsp;one &lt;3 &#233;</p><!-- x --><form>Name <input></form><aside>Side</aside>
<ul><li>a<li>b <i>c</i></ul><div class="comments"><p>Nice!</p></div></article><footer>&copy; F</footer></body></html>"""


def test_article():
    assert "\n".join(x for x, p in H.lines_of(PAGE) if p == H.ARTICLE) == \
        "Title & more\nFirst line.\nSecond one <3 é\na\nb c"


def test_names_of_parts():
    html = """<main class="has-sidebar"><div class="article-header"><h1>Title</h1></div><p class="lead">Text</p>
    <div class="sideBar">no</div><article class="comment"><p>first!</p></article><div role="search">no</div><p hidden>no</p></main>
    <div class="page-header">no</div><div id="footerLinks">no</div>"""
    assert [x for x, p in H.lines_of(html) if p == H.ARTICLE] == ["Title", "Text"]
    assert all(p == H.ARTICLE for _, p in H.lines_of(html))


@pytest.mark.parametrize("html", [
    '<article><p>A</p><h2 id="related-work">B</h2><p id="notice-period">C</p></article>',
    '<article><p>A</p><section id="search-and-rescue">B</section><div class="social-history"><p>C</p></div></article>',
    '<div class="layout has-sidebar"><article><p>A<p>B<p>C</article><div class="side-bar">no</div></div>',
    '<div id="page-with-footer" class="no-sidebar"><main><p>A<p>B<p>C</main></div>',
    '<div class="banner-page"><p>x</p><article><p>A<p>B<p>C</article><nav>no</nav></div>',
    '<div class="social-history"><p>A<p>B<p>C</div><div class="social">no</div>'])
def test_parts_of_names_drop_no_article(spark, html):
    rows = spark.createDataFrame([(1, None, html)], "page_id long, url string, html string")
    assert H.extract_text(rows).first().text == "A\nB\nC"


@pytest.mark.parametrize("copies", [3, 40])
def test_runs_of_copies_share_one_text(spark, copies):
    page = "<div>Top</div><p>{}</p><div>Bottom</div><p>{}</p>"
    rows = [(0, "http://h.org/a", page.format("first", "Old"))]
    rows += [(1 + i, f"http://h.org/b/{i:03d}", page.format("copy", "New")) for i in range(copies)]
    rows += [(900, "http://h.org/c", page.format("last", "New")), (901, "http://i.org/a", page.format("copy", "New")),
             (902, "http://i.org/b", page.format("copy", "New"))]
    want = {i: "copy" for i in range(1, copies + 1)} | {0: "first\nOld", 900: "last"} | {i: "Top\ncopy\nBottom\nNew" for i in (901, 902)}
    rows.append((903, "http://h.org/b/000", page.format("copy", "New").replace("div", "main")))  # the same lines, marked up otherwise
    want[903] = "copy"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r.page_id: r.text for r in H.extract_text(df).collect()} == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # runs cut by ranges
    try:
        assert {r.page_id: r.text for r in H.extract_text(df).collect()} == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_unclear_blocks_are_differenced(spark):
    rows = [(i, f"http://h.org/{i}", f'<div class="page-top">Top</div><div class="share-page">Page {i}</div>'
             f'<article><p>Story {i}<p>Licence</p><div class="share-buttons"><p>Share</p><p>Note {i}</p></div></article>') for i in range(3)]
    rows += [(i, f"http://l.org/{i}", f'<div class="menu-left"><p>Menu</p><p>Text {i}</p></div>') for i in range(5, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract_text(df).collect()} == \
        {i: f"Story {i}\nLicence\nNote {i}" for i in range(3)} | {i: f"Text {i}" for i in range(5, 7)}


@pytest.mark.parametrize("html,want", [(None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"),
                                       ("<article></article>", ""), ("a &amp b &am", "a & b &am"), ("<p>x</b> y", "x y")])
def test_odd_pages(spark, html, want):
    rows = spark.createDataFrame([(1, None, html, "t", 7)], "page_id long, url string, html string, text string, lines int")
    assert [tuple(r) for r in H.extract_text(rows).collect()] == [(1, None, want, len(want))]


def test_differencing_across_ranges(spark):
    frame = "<div>Top of {h}</div><p>{body}</p><div>Bottom of {h}</div><p>Licence of {h}</p>"
    rows, want = [], {}
    for h in range(3):
        for i in range(60 if h == 0 else 2):
            rows.append((len(rows), f"http://h{h}.org/a/{i:03d}", frame.format(h=h, body=f"story {h} {i}")))
            want[len(rows) - 1] = f"story {h} {i}"
    rows.append((500, "http://alone.org/", "<p>only</p><p>page</p>"))
    want[500] = "only\npage"
    rows.append((501, "http://copy.org/1", "<p>same</p>"))
    rows.append((502, "http://copy.org/2", "<p>same</p>"))
    want[501] = want[502] = "same"
    rows.append((503, "http://h1.org/a/zz", "<div>Top of 1</div><article>kept Top of 1</article>"))
    want[503] = "kept Top of 1"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = {r.page_id: r.text for r in H.extract_text(df).collect()}
    assert got == want
    assert H.extract_text(df.limit(0)).count() == 0


def test_pages_with_articles_are_differenced(spark):
    card = "<article><h2>Latest</h2><p>Teaser of the site</p></article>"
    body = "<p>A body of page {i}, in a paragraph beside the cards.</p><p>It goes on for a second line {i}.</p>"
    rows = [(i, f"http://h.org/{i}", f"<div>Top</div>{card}{body.format(i=i)}<div>Bottom</div>") for i in range(5)]
    want = {i: f"A body of page {i}, in a paragraph beside the cards.\nIt goes on for a second line {i}." for i in range(5)}
    for i in range(10, 13):  # a licence line that articles share stays; shared lines of main go
        rows.append((i, f"http://l.org/{i}", f"<main><p>Menu</p><article><p>Story {i}</p><p>Licence</p></article></main>"))
        want[i] = f"Story {i}\nLicence"
    rows += [(20, "http://n.org/1", "<i>3 May</i><article><p>One line of it</p></article>"),  # part of its neighbour
             (21, "http://n.org/2", "<article><p>One line of it</p><p>Two</p></article>")]
    want |= {20: "3 May\nOne line of it", 21: "One line of it\nTwo"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in H.extract_text(df).collect()} == want


def test_query_keeps_every_article(spark):
    import re
    from html import unescape

    from orderlens.llm import queries
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.QUERIES["op5_html_text"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    for i, r in pages.items():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[i].text == "\n".join(x for x in blocks if x)
        assert got[i].n_chars == len(got[i].text) and got[i].url == r.url

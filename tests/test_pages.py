import html as html_lib
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobsignals.functions import html as h
from jobsignals.operators import pages as pg

PAGE = """<!DOCTYPE html><html><head><style>p{}</style><script>x = "<div class='job-description'>no</div>"</script>
<body><!-- <div class="company-name-label"><a>hidden</a></div> -->
<h3 class="title"><a href="/j/1">A</a></h3>
<H3 CLASS='big title'><span><a data-x="1" href='https://other.example/j/2?a=1&amp;b=2'>B</a></span></H3>
<h3 class="subtitle"><a href="/no">C</a></h3>
<div class="company-name-label-x"><a>wrong</a></div>
<div class="x company-name-label"><span>no link</span></div>
<div class="company-name-label"><div>in</div><a href="/c"> ACME
 &amp; Co </a></div>
<div id="d" class=job-description><div><p>intro <b>Mô tả</b> công việc</p>viết code</div>
<div>Yêu cầu ứng viên<ul><li>biết   Java</li><li>SQL&nbsp;Server</li></ul></div>Quyền lợi<br>10 triệu<script>no()</script></div>
<div>Quyền lợi khác</div>
<a class="link search-from-tag item" href="/t"><i>Chuyên môn Tester</i></a><a class="item search-from-tag link">Z</a>
</body></html>"""
UNCLOSED = '<div class="job-description">Quyền lợi <b>9 triệu<div>x'


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [("https://site.example/jobs/list.html?page=2#top", PAGE), ("https://site.example", UNCLOSED),
         ("https://site.example/n", None), ("https://site.example/e", "")],
        "url string, html string",
    )


def test_links(pages):
    assert [tuple(r) for r in pg.page_links(pages).collect()] == [
        ("https://site.example/jobs/list.html?page=2#top", "https://site.example/j/1"),
        ("https://site.example/jobs/list.html?page=2#top", "https://other.example/j/2?a=1&b=2"),
    ]


def test_same_link_twice_gives_two_rows(spark):
    html = '<h3 class="title"><a href="/j/1">A</a></h3>' * 2
    df = spark.createDataFrame([("https://s.example/", html)], "url string, html string")
    assert pg.page_links(df).count() == 2


def test_records(pages):
    rows = [r.asDict() for r in pg.page_postings(pages).collect()]
    assert rows[0] == {
        "id": rows[0]["id"], "name": "ACME & Co", "chuyen_mon": "Tester",
        "mo_ta_cong_viec": "viết code", "yeu_cau_cong_viec": "biết Java\nSQL Server",
        "quyen_loi": "10 triệu", "dia_diem_lam_viec": "N/A", "thoi_gian_lam_viec": "N/A",
        "cach_thuc_ung_tuyen": "N/A",
    }
    assert rows[1]["quyen_loi"] == "9 triệu\nx" and rows[1]["name"] == "N/A"
    for row in rows[2:]:
        assert set(row.values()) == {row["id"], "N/A"}
    assert len({r["id"] for r in rows}) == 4
    assert "chuyen_mon" not in pg.page_postings(pages, pg.Selectors(specialty=None)).columns


def test_block_present_but_empty_is_not_missing(spark):
    html = '<div class="company-name-label"><a></a></div><div class="job-description">Quyền lợi</div>'
    df = spark.createDataFrame([("https://s.example/", html)], "url string, html string")
    row = pg.page_postings(df).first()
    assert row.name == "" and row.quyen_loi == "" and row.mo_ta_cong_viec == "N/A"


@pytest.mark.parametrize("link, full", [
    ("a.html", "https://s.example/d/a.html"), ("/a", "https://s.example/a"), ("//t.example/a", "https://t.example/a"),
    ("?q=1", "https://s.example/d/p.html?q=1"), ("#x", "https://s.example/d/p.html?o=2#x"),
    ("mailto:a@b.example", "mailto:a@b.example"), ("", "https://s.example/d/p.html?o=2"),
])
def test_absolute_links(evaluate, link, full):
    page = F.lit("https://s.example/d/p.html?o=2#f")
    assert evaluate(lambda c: h.absolute(c, page), [link]) == [full]


def test_listing_urls(spark):
    rows = pg.listing_urls(spark, 3, 5, "https://s.example/?page=%s&x=").collect()
    assert [r.url for r in rows] == [f"https://s.example/?page={i}&x=" for i in (3, 4, 5)]


@pytest.mark.parametrize("html", ["<div " * 3000, "<!--" * 30_000, "<script>" * 30_000, "<div>" * 30_000,
                                  '<div class="job-description">' * 2_000, "<br>" * 50_000, " \n" * 100_000])
def test_hostile_pages_end(spark, html):
    df = spark.createDataFrame([("https://s.example/", html)], "url string, html string")
    assert pg.page_postings(df).count() == 1 and pg.page_links(df).collect() == []


PIECES = ["<div>", "</div>", '<div class="a job-description">', "<DIV CLASS='job-description'>", "<p>", "</p>", "x ", "\n",
          "y", "<br>", "<b>", "</b>", "&amp;", "<h3>", "</h3>", "</div >", "<divx>"]


def py_description(html):
    """The same reading of a page, step by step."""
    pieces = re.findall(r"<[^<>]*>|[^<]+", html)
    opening = [i for i, p in enumerate(pieces) if p.lower().startswith("<div ") and "job-description" in p]
    if not opening:
        return None
    depth, text = 1, ""
    for p in pieces[opening[0] + 1:]:
        low = p.lower()
        depth += low.startswith(("<div>", "<div ")) - low.startswith(("</div>", "</div "))
        if depth == 0:
            break
        if low.startswith("<"):
            name = re.match(r"</?(\w+)", low).group(1)
            text += "\n" if name in h.BLOCK_TAGS else ""
        else:
            text += re.sub(r"\s+", " ", p)
    lines = [re.sub(" +", " ", line).strip() for line in text.split("\n")]
    return "\n".join(line for line in lines if line).replace("&amp;", "&")


def test_random_pages(evaluate):
    texts = []

    @settings(max_examples=800, database=None, deadline=None, derandomize=True)
    @given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
    def gather(t):
        texts.append(t)

    gather()
    got = evaluate(lambda c: h.visible_text(h.first_inner(c, "div.job-description")), texts)
    for t, g in zip(texts, got):
        assert g == py_description(t), repr(t)


def test_character_references(evaluate):
    texts = ["a &amp; b", "&amp;lt;", "&lt;b&gt;", "&#39;&#039;&#x27;&apos;", "&agrave;&Ocirc;&eacute;&euro;", "&#7871;&#x1EBF;",
             "&#128512;", "&#0;&#xD800;&#x110000;", "&unknown;", "&amp", "&;&&#;&#x;", "x & y; z", "AT&T; &copy;", "", "&" * 5000]
    want = [html_lib.unescape(t) for t in texts]
    want[texts.index("&amp")] = "&amp"  # a reference ends with its semicolon
    assert evaluate(h.decode_entities, texts + ["a&nbsp;b", None]) == want + ["a b", None]


def test_links_resolve_like_a_browser(evaluate):
    pages = ["https://s.example/a/b/c.html?q=1", "https://s.example/", "https://s.example", "http://s.example/a/b/"]
    links = ["x", "./x", "../x", "../../x", "../../../../x", "/a/../b/./c", "x/..", "x/.", "..", ".", "../x?a=../b#c/..", "/x/y/../../z/",
             "?a=/../b", "x.y", "..x", "https://t.example/a/../b", "//t.example/./a", "a/b/../c"]
    for page in pages:
        got = evaluate(lambda c: h.absolute(c, F.lit(page)), links)
        # urljoin() leaves the path alone when the link names a host; a browser does not
        other = {"https://t.example/a/../b": "https://t.example/b", "//t.example/./a": page.split("/")[0] + "//t.example/a"}
        assert got == [other.get(x) or urljoin(page, x) for x in links], page


class Links(HTMLParser):
    """What the standard library's parser sees."""

    def __init__(self, page):
        super().__init__()
        self.found = []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        if tag == "a" and "href" in dict(attrs):
            self.found.append(dict(attrs)["href"] or "")


ODD_TAGS = ["<a href=\"/it's-a-job\">", '<a href="/a b">', '<a title="a>b" href="/y">', '<a data-x=" href=/no" href="/yes">',
            "<a href=/x/y>", "<a href=''>", '<A\nHREF = "/q?a=1&amp;b=2" x>', "<a name=x>", "<a class href=k>", "<abbr href=no>",
            "<a data-href=no title='href=\"x\"' href='&dstrok;'>"]


def test_attributes_as_the_standard_parser_reads_them(evaluate):
    got = evaluate(lambda c: h.attributes(c, "a", "href"), ODD_TAGS + ["".join(ODD_TAGS)])
    assert got == [Links(t).found for t in ODD_TAGS + ["".join(ODD_TAGS)]]


@pytest.mark.parametrize("step, html, want", [
    ("li", "<li>a<ul><li>b</li></ul>c</li>d<li>e", ["a<ul><li>b</li></ul>c", "b", "e"]),
    ("article", "<article>a<article>b</article>c</article>", ["a<article>b</article>c", "b"]),
    ("nav", "<nav>a<nav>b</nav>c</nav>", ["a<nav>b</nav>c", "b"]),
    ("div.x", '<div class="x">1<div>2</div><div class="y x">3</div>4</div>5', ['1<div>2</div><div class="y x">3</div>4', "3"]),
    ("div.x", '<div data-x="a>b" class="x">in</div>', ["in"]), ("div.x", '<div data-class="x">in</div>', []),
    ("h3", "<h3>a</h3>b<h3>c", ["a", "c"]),
])
def test_elements(evaluate, step, html, want):
    assert evaluate(lambda c: h.all_inner(c, step), [html]) == [want]
    assert evaluate(lambda c: h.first_inner(c, step), [html]) == (want[:1] or [None])


def test_references_of_html_5(evaluate):
    texts = ["&#00000065;&#x0000000000000041;", "&abreve;&dstrok;&itilde;", "&#150;&#x80;", "&#99999999999999999999;", "&NotEqualTilde;"]
    assert evaluate(h.decode_entities, texts) == [html_lib.unescape(t) for t in texts]


def test_runs_and_references(evaluate):
    texts = ["a  \n \n  b   c \n", " \n\n x", "a &amp;&lt; b && &; &no &nosuch; &#65;&#x42;&amp;amp;", "1 < 2", "a\t\tb \x0b c", "<p>a</p>  <p>b", "&", ""]
    assert evaluate(h.visible_text, texts) == [
        "a b c", "x", "a &< b && &; &no &nosuch; AB&amp;", "1 < 2", "a b c", "a\nb", "&", ""]

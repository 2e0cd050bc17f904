"""Elements by selectors, against trees of the standard library's parser."""

import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobsignals.functions import html as h
from jobsignals.functions.selectors import elements, steps
from jobsignals.operators import pages as pg

ITEMS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
BLOCKS = {"div", "p", "ul", "ol", "table", "h3", "article", "nav", "dl"}
VOID = {"br", "img", "input"}


class Tree(HTMLParser):
    """Nodes as [tag, attributes, children, parent, start, end]."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.page, self.top = page, ["", {}, [], None, 0, len(page)]
        self.here = self.top
        self.lines = [0]
        for line in page.split("\n"):
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.feed(page)
        self.close()
        while self.here is not self.top:
            self.up(len(page))

    def place_of_tag(self):
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def up(self, end):
        self.here[5] = end
        self.here = self.here[3]

    def around(self):
        out, node = [], self.here
        while node is not self.top:
            out.append(node)
            node = node[3]
        return out

    def end_up_to(self, node, end):
        while self.here is not node:
            self.up(end)
        self.up(end)

    def handle_starttag(self, tag, attrs):
        start = self.place_of_tag()
        ended, scope = ITEMS.get(tag, (set(), set()))
        outermost = None
        for node in self.around():
            if node[0] in scope:
                break
            if node[0] in ended:
                outermost = node
        if outermost:
            self.end_up_to(outermost, start)
        if tag in BLOCKS:
            for node in self.around():
                if node[0] in ("table", "td", "th"):
                    break
                if node[0] == "p":
                    self.end_up_to(node, start)
                    break
        inside = start + len(self.get_starttag_text())
        first = {}
        for name, value in attrs:
            first.setdefault(name, value or "")
        node = [tag, first, [], self.here, inside, inside]
        self.here[2].append(node)
        if tag not in VOID:
            self.here = node

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        for node in self.around():
            if node[0] == tag:
                self.end_up_to(node, self.place_of_tag())
                return


def walk(node):
    for child in node[2]:
        yield child
        yield from walk(child)


def found(page, test):
    return [(n[0], page[n[4]:n[5]]) for n in walk(Tree(page).top) if test(n)]


def place(n):
    return next(i for i, c in enumerate(n[3][2], 1) if c is n)


def above(n):
    while n[3] is not None and n[3][0]:
        n = n[3]
        yield n


#: Selectors and what they mean, written out.
MEANT = {
    "*": lambda n: True,
    "li": lambda n: n[0] == "li",
    "ul > li": lambda n: n[0] == "li" and n[3][0] == "ul",
    "div p": lambda n: n[0] == "p" and any(a[0] == "div" for a in above(n)),
    "div.a > p, li b": lambda n: (n[0] == "p" and n[3][0] == "div" and "a" in n[3][1].get("class", "").split())
    or (n[0] == "b" and any(a[0] == "li" for a in above(n))),
    "ul li:nth-child(2)": lambda n: n[0] == "li" and place(n) == 2 and any(a[0] == "ul" for a in above(n)),
    "*:nth-child(odd)": lambda n: place(n) % 2 == 1,
    "td:first-child": lambda n: n[0] == "td" and place(n) == 1,
    "a[href]": lambda n: n[0] == "a" and "href" in n[1],
    'div a[href^="/j"]': lambda n: n[0] == "a" and n[1].get("href", "").startswith("/j") and any(a[0] == "div" for a in above(n)),
    "#x b": lambda n: n[0] == "b" and any(a[1].get("id") == "x" for a in above(n)),
    "div div > b:nth-child(-n+2)": lambda n: n[0] == "b" and n[3][0] == "div" and place(n) <= 2
    and any(a[0] == "div" for a in list(above(n))[1:]),
}
PIECES = ["<div>", "</div>", '<div class="a b">', "<DIV CLASS='b a' ID=x>", "<p>", "</p>", "<ul>", "</ul>", "<li>", "</li>", "<b>", "</b>",
          '<a href="/j?a=1&amp;b=>">', "</a>", "<a name=q>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<br>", "<br/>", "<img src='x>y'>",
          "<!-- <b> -->", "<script>'<b>'</script>", "x ", "\n", "&lt;b&gt;", "<h3>", "</h3>", "<option>", "<dl><dt>", "<dd>", "</dl>"]


def test_random_pages_against_the_standard_parser():
    @settings(max_examples=1500, database=None, deadline=None, derandomize=True)
    @given(st.lists(st.sampled_from(PIECES), max_size=22).map("".join))
    def compare(page):
        for selector, test in MEANT.items():
            assert [(e.tag, page[e.start:e.end]) for e in elements(page, (selector,))] == found(page, test), (page, selector)

    compare()


def test_all_selectors_at_once_find_what_each_finds():
    page = "".join(PIECES * 2)
    together = elements(page, tuple(MEANT))
    for i, selector in enumerate(MEANT):
        assert [(e.start, e.end) for e in together if e.selector == i] == [(e.start, e.end) for e in elements(page, (selector,))]


@pytest.mark.parametrize("page", [
    "<li>" * 30_000, "<div>" * 30_000 + "</span>" * 30_000, "<ul>" + "<span>" * 30_000 + "<li></li>" * 30_000, '<a ="' * 30_000,
    "<div " * 30_000, "<!--" * 30_000, "<script>" * 30_000, "<" * 100_000, '<p a="' * 30_000, "<td>" * 30_000, "</p>" * 50_000])
def test_hostile_pages_end(page):
    start = time.perf_counter()
    elements(page, ("ul li", "p > b", "li:nth-child(2)"))
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("wrong", ["", "  ", "a,,b", "a[", "p:hover", ":nth-child(x)", "a >", ">", "a..b"])
def test_wrong_selectors(wrong):
    with pytest.raises(ValueError):
        steps(wrong)


def test_pages(spark):
    page = '<nav><ul><li><a href="/1">A</a><li><a class=k href="/2?a&amp;b">B<b>c</a></ul></nav>'
    pages = spark.createDataFrame([(1, page, "q"), (2, None, "q"), (3, "", "q"), (None, page, None)], "id int, html string, name string")
    rows = pg.select_elements(pages, {"second": "li:nth-child(2) > a", "all": "li"}, keep=["id"]).collect()
    assert [(r.id, r.name, r.nth, r.tag, r.html) for r in rows if r.id] == [
        (1, "all", 1, "li", '<a href="/1">A</a>'), (1, "all", 2, "li", '<a class=k href="/2?a&amp;b">B<b>c</a>'),
        (1, "second", 1, "a", "B<b>c")]
    assert [r.attributes for r in rows if r["name"] == "second"] == [{"class": "k", "href": "/2?a&b"}] * 2
    assert {r.id for r in rows} == {1, None}
    assert pg.select_elements(pages.limit(0), {"a": "a"}, keep=["id", "name"][:1]).collect() == []
    with pytest.raises(ValueError):
        pg.select_elements(pages, {"a": "p:hover"})


def test_many_open_items_are_read_in_linear_time(spark):
    """The column expressions too match tags by sorting, not by reading the rest again."""
    for n in (4_000, 30_000):
        df = spark.createDataFrame([("<ul>" + "<li>x" * n + "</li></ul>",)], "html string")
        start = time.perf_counter()
        assert df.select(F.size(h.all_inner(F.col("html"), "li")).alias("n")).first().n == n
        assert time.perf_counter() - start < 20

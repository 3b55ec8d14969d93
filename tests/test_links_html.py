from __future__ import annotations

import random
from urllib.parse import urljoin

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rategrid.functions.markup import read_headed, read_links, read_tables
from rategrid.functions.urls import absolute_url
from rategrid.operators.faults import worked
from rategrid.operators.html_tables import (
    headed_tables,
    named_rows,
    html_tables,
    newest_table,
    promote_header,
    rows_with_header,
    table_cells,
    tables_and_headings,
)
from rategrid.operators.links import (
    award_path,
    latest_links,
    page_links,
    resolve_sources,
    check_order,
    order_rejects,
    page_rejects,
)
from rategrid.sources.readers import read_html_files


LINKED = [
    ('<a href="x">1</a><A HREF="y" >2</A>', ["x", "y"]),
    ("<a href='x y'>1</a><a href=z>2</a>", ["x y", "z"]),
    ('<a name="n">1</a><a class="c" href="x" title="t">2</a>', [None, "x"]),
    ('<!-- <a href="no"> --><a href="x">1</a><!-- open <a href="no">', ["x"]),
    ("<script>'<a href=\"no\">'</script><a href=\"x\">1</a>", ["x"]),
    ('<abbr href="no"><a data-href="no" href="x?a=1&amp;b=2">1</a>', ["x?a=1&b=2"]),
    ('<a title="href=\'no\' >" href="x">1</a>', ["x"]),
    ('<a href="caf&eacute;&amp;lt;">1</a><a href="p&#233;">2</a>', ["café&lt;", "pé"]),
    ('<a\n  href = "x"\n>1</a>', ["x"]),
    ("<p>none</p>", []),
    ('<a href="">1</a>', [""]),
    ("<a href=x title=it's>1</a><a href='y'>2</a>", ["x", "y"]),
]


def test_links(frame):
    pages = frame([(i, html) for i, (html, _) in enumerate(LINKED)], "id int, html string")
    found = {r.id: r.links for r in page_links(pages).collect()}
    assert found == {i: links for i, (_, links) in enumerate(LINKED)}


BASES = ["http://h.org/a/b/c.html?q=1#f", "https://h.org", "http://h.org/a/b/", "https://h.org?x=/y"]
LINKS = ["/x", "x/y", "../x", "../../../x", "./x", "x/./y/../z", "..", ".", "?q=2", "#top",
         "//cdn.org/z", "ftp://o.org/p", "mailto:a@b.c", "/a/../b/./c?d=../e", "x?y=/../z", "x/.."]


def test_absolute_url(frame):
    pairs = frame([(b, x) for b in BASES for x in LINKS], "base string, link string")
    found = pairs.select("base", "link", absolute_url(F.col("base"), F.col("link")).alias("url"))
    for r in found.collect():
        assert r.url == urljoin(r.base, r.link), (r.base, r.link)


def test_absolute_url_of_empty_link_drops_the_fragment(one):
    assert one(absolute_url(F.lit("http://h/a#f"), F.lit(""))) == "http://h/a"
    assert one(absolute_url(F.lit("http://h/a"), F.lit(None).cast("string"))) is None


PAGE = '<a href="/old-Award.pdf">1</a><a href="/other.pdf">2</a><a href="new-Award.pdf">3</a>'


def test_latest_link(frame):
    wanted = {
        ("Award", "fwd"): "http://h/d/new-Award.pdf",
        ("Award", "REV"): "http://h/old-Award.pdf",
        ("^/other", "fwd"): "http://h/other.pdf",
        ("none", "fwd"): None, ("", "fwd"): None, (None, "rev"): None, ("Award", "up"): None,
    }
    index = frame([("http://h/d/i", PAGE, *key) for key in wanted],
                  "url string, html string, pattern string, order string")
    found = {(r.pattern, r.order): r.latest for r in latest_links(index).collect()}
    assert found == wanted


def test_resolve_sources(frame):
    pages = frame([("http://h/d/i", PAGE)], "url string, html string")
    sources = frame(
        [("A", "http://h/d/i", "IDX", "Award", "fwd"), ("B", "http://h/d/i", "IDX", "Award", "rev"),
         ("C", "http://h/doc", "WEB", None, "fwd"), ("D", "http://gone", "IDX", "x", "fwd"),
         ("E", "http://h/d/i", "IDX", None, "fwd")],
        "state string, url string, type string, pattern string, order string")
    found = {r.state: r.doc_url for r in resolve_sources(sources, pages).collect()}
    wanted = {"A": "http://h/d/new-Award.pdf", "B": "http://h/old-Award.pdf",
              "C": "http://h/doc", "D": None, "E": None}
    assert found == wanted
    doubled = pages.unionByName(pages)
    again = resolve_sources(sources, doubled).collect()
    assert {r.state: r.doc_url for r in again} == wanted and len(again) == len(wanted)
    assert [tuple(r) for r in page_rejects(doubled).collect()] == [
        ("page", "http://h/d/i", "2 pages of one address")]
    assert page_rejects(pages).count() == 0


def test_bad_order(frame):
    sources = frame([("A", "fwd"), ("B", "Rev"), ("C", "up"), ("D", None)],
                    "state string, order string")
    checked = check_order(sources)
    assert sorted(r.state for r in worked(checked).collect()) == ["A", "B"]
    assert sorted(r.key for r in order_rejects(checked).collect()) == ["C", "D"]
    strict = check_order(sources, strict=True)
    assert [r.reason for r in strict.where("state < 'C'").collect()] == [None, None]
    with pytest.raises(PySparkException, match="order must be"):
        strict.collect()


def test_award_path(one):
    assert one(award_path(F.lit("Qld"), F.lit("HTML"), "awards")) == "awards/QLD.html"


TABLES = [
    "<table><tr><td> a </td><td>b</td></tr><tr><th>c</th></tr></table>",
    "<TABLE border=1><thead><tr><th>H<br>1</th></tr></thead><tr><td><b>x</b>&nbsp;</td></tr></TABLE>",
    "<p>none</p>",
    "<table></table><table><tr></tr></table>",
    "<table><tr><td>a &lt; b &amp;amp; c</td></tr></table>",
    "<!-- <table><tr><td>no</td></tr></table> --><table><tr><td>yes</td></tr></table>",
    "<table><tr><td>a<td>b<tr><td>c</table>",
    "<table><tr><td rowspan=2>a<td colspan=2>b</tr><tr><td>c</td><td>d</td></tr></table>",
    "<table><tr><td>a<table><tr><td>n</td></tr></table></td><td>b</td></tr></table>",
    "<table><tr><td>caf&eacute;</td></tr></table>",
    "<table><td>no row</td></table>",
    "<table><tr><td>open",
    "<!DOCTYPE html><?xml version='1'?><![unknown[<table><tr><td>a<td>b</table>",
]


def test_tables(frame):
    docs = frame(list(enumerate(TABLES)), "id int, html string")
    found = {r.id: r.tables for r in html_tables(docs).collect()}
    assert found == {
        0: [[["a", "b"], ["c"]]],
        1: [[["H1"], ["x"]]],
        2: [],
        3: [[], [[]]],
        4: [[["a < b &amp; c"]]],
        5: [[["yes"]]],
        6: [[["a", "b"], ["c"]]],
        7: [[["a", "b", "b"], ["a", "c", "d"]]],
        # An outer table also holds the rows and cells nested in it.
        8: [[["an", "n", "b"], ["n"]], [["n"]]],
        9: [[["café"]]],
        10: [[["no row"]]],
        11: [[["open"]]],
        12: [],
    }


def test_quick_reading_equals_the_parser(frame):
    """Markup that the JVM reads by itself gives what the parser gives."""
    for html in TABLES[:6]:
        if "<!--" not in html:
            row = html_tables(frame([(html,)], "html string")).first()
            assert row.tables == read_tables(html)


def test_row_spans_end_with_the_table():
    assert read_tables("<table><tr><td rowspan=9>a</table><table><tr><td>b</table>") == [
        [["a"]], [["b"]]]
    assert read_tables("<table><tr><td>x<td rowspan=3>a<tr><td>y<tr><td>z<tr><td>w</table>") == [
        [["x", "a"], ["y", "a"], ["z", "a"], ["w"]]]


def test_newest_table_and_header(frame):
    html = ("<table><tr><td>old</td></tr></table>"
            "<table><tr><td>Pay</td><td>Pay</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>")
    docs = html_tables(frame([(html, "fwd"), (html, "rev"), (html, "up"), ("<p>", "fwd")],
                             "html string, order string"))
    picked = [r.rows for r in docs.select(newest_table(F.col("tables"), F.col("order"))
                                          .alias("rows")).collect()]
    assert picked == [[["Pay", "Pay"], ["1", "2", "3"]], [["old"]], None, None]
    cells = docs.where("order = 'fwd'").limit(1).select(
        F.inline(rows_with_header(newest_table(F.col("tables"), F.col("order")))))
    assert [tuple(r) for r in cells.collect()] == [
        (1, 0, "Pay", "1"), (1, 1, "Pay", "2"), (1, 2, None, "3")]


def test_promote_header_of_cells(frame):
    docs = frame([(1, TABLES[0]), (2, "<table><tr><td>h</td></tr></table>")],
                 "doc_id int, html string")
    cells = table_cells(html_tables(docs).select("doc_id", "tables"))
    found = promote_header(cells, ["doc_id", "table_no"]).select("doc_id", "row_no", "col_no", "header", "cell")
    assert [tuple(r) for r in found.collect()] == [(1, 1, 0, "a", "c")]


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_text('<a href="F.html#1">Page 1</a>\n<a href="F.html#2">Page 2</a>')
    pages = read_html_files(spark, str(tmp_path))
    row = page_links(pages).first()
    assert row.links == ["F.html#1", "F.html#2"] and row.path.endswith("a.html")


# Pieces that are put together at random; quick reading must give what the parser gives.
PIECES = [
    "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "<td title=\"a > b\">",
    "<td title='x<y'>", "<a href=\"u\">", "<a class=\"c\"href=\"v\">", "<a/href=\"w\">", "<a href='q>r'>", "</a>",
    "x < 5 and y > 3", "AT&ampT &copy 1", "a &lt; b", "&eacute;", "R&D", "5", " ", "<br>", "<b>", "</b>",
    "<!-- c -->", "<!-- <td> -->", "<td title=\"<!--\">", "<script>if (a<b) \"<td>\"</script>", "<a\nhref = z >",
    "<a data-href=n>", "<td colspan=2>", "<p title=it's>", "<>", "< td>", "</ td>", "&#160;", "&nbsp;", "<tr/>",
]


def test_quick_reading_equals_the_parser_on_any_markup(frame):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        parts = [rng.choice(PIECES) for _ in range(rng.randint(1, 9))]
        if i % 2:
            cells = "".join(f"<{t}>{rng.choice(PIECES)}</{t}>" for t in rng.choices(["td", "th"], k=3))
            parts = [f"<table><tr>{cells}</tr></table>", *parts[:2]]
        rows.append((i, "".join(parts)))
    docs = frame(rows, "id int, html string")
    read = headed_tables(html_tables(page_links(docs)))
    found = {r.id: r for r in read.collect()}
    for i, html in rows:
        assert found[i].links == read_links(html), html
        assert found[i].tables == read_tables(html), html
        assert found[i].headed == read_headed(html), html


def test_marked_cells(frame):
    rows = [(0, '<table><tr><td title="a > b">5</td><td>x < 5 and y > 3</td><td>AT&ampT &copy 1</td></tr></table>')]
    (row,) = html_tables(frame(rows, "id int, html string")).collect()
    assert row.tables == [[["5", "x < 5 and y > 3", "AT&T \u00a9 1"]]]


def test_spans_are_bounded_on_request_only(frame):
    docs = frame([("<table><tr><td colspan=1200>a</td></tr></table>",)], "html string")
    assert len(html_tables(docs).first().tables[0][0]) == 1200
    assert len(html_tables(docs, most_span=7).first().tables[0][0]) == 7


def test_named_rows(frame):
    html = ("<table><tr><th>Level</th><th>Pay</th></tr><tr><td>P1</td><td>5</td></tr><tr><td>P2</td></tr></table>"
            "<table><tr><td>a</td></tr><tr><td>b</td><td>c</td></tr></table><table></table>")
    read = headed_tables(html_tables(frame([(html,)], "html string")))
    found = []
    for t in range(3):
        rows = named_rows(F.col("tables")[t], F.col("headed")[t])
        found.append([tuple(r) for r in read.select(F.inline(rows)).collect()])
    assert found == [
        [(0, 0, "Level", "P1"), (0, 1, "Pay", "5"), (1, 0, "Level", "P2"), (1, 1, "Pay", None)],
        [(0, 0, "X1", "a"), (0, 1, "X2", None), (1, 0, "X1", "b"), (1, 1, "X2", "c")],
        [],
    ]


def test_tables_and_headings_in_one_reading(frame):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 9)))) for i in range(200)]
    rows += [(1000 + i, html) for i, html in enumerate(TABLES)] + [(2000, None)]
    docs = frame(rows, "id int, html string")
    both = {r.id: (r.tables, r.headed) for r in tables_and_headings(docs).collect()}
    apart = {r.id: (r.tables, r.headed) for r in headed_tables(html_tables(docs)).collect()}
    assert both == apart
    plan = tables_and_headings(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1

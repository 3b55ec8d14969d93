"""Patterns that do not compile, and addresses as keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rategrid.functions.text import (
    broken,
    drop_matching,
    first_match,
    last_match,
    matches,
    numbered,
    split_lines,
)
from rategrid.functions.urls import url_key
from rategrid.operators import sections as S
from rategrid.operators.links import (
    check_pattern,
    latest_links,
    pattern_rejects,
    resolve_sources,
    source_rejects,
)

BROKEN = ["(", "[a", "*", "(?<x", "a\\", "(?<n>a)\\k<m>", "a{2", "\\p{Nope}"]
GOOD = ["a", "", "^b$", "(?i)A", "[ab]", r"\s"]


def test_which_patterns_are_broken(frame):
    rows = frame([(p,) for p in [*BROKEN, *GOOD, None]], "p string")
    found = {r.p: r.b for r in rows.select("p", broken(F.col("p")).alias("b")).collect()}
    assert found == {**dict.fromkeys(BROKEN, True), **dict.fromkeys(GOOD, False), None: False}


def test_helpers_go_on_at_broken_patterns(frame):
    rows = frame([(p, "b\na c\nb\n") for p in [*BROKEN, "a", "b", None]], "p string, text string")
    lines, p = split_lines(F.col("text")), F.col("p")
    found = {
        r.p: (r.last, r.first, r.m, [x.line for x in r.kept])
        for r in rows.select(
            "p", last_match(lines, p).alias("last"), first_match(lines, p).alias("first"),
            matches(F.col("text"), p).alias("m"), drop_matching(numbered(lines), p).alias("kept"),
        ).collect()
    }
    all_lines = ["b", "a c", "b", ""]
    nothing = (None, None, None, all_lines)
    assert found == {**dict.fromkeys(BROKEN, nothing), None: nothing,
                     "a": (2, 2, True, ["b", "b", ""]), "b": (3, 1, True, ["a c", ""])}


LAYOUT = "start_pattern string, start_offset int, end_pattern string, end_offset int, skip_pattern string"
LAYOUTS = {
    1: ("a", 1, "z", -1, "k"), 2: ("(", 1, "z", -1, "k"), 3: ("a", 1, "[", -1, "k"), 4: ("a", 1, "z", -1, "*"),
    5: (None, 1, "z", -1, "*"), 6: ("a", 1, "z", -1, None), 7: ("a", 1, "z", -1, ""),
}
REASONS = {"2": "bad_start_pattern", "3": "bad_end_pattern", "4": "bad_skip_pattern", "5": "bad_skip_pattern"}
KEPT = {1: [(2, "b"), (4, "c")], 6: [(2, "b"), (3, "k"), (4, "c")], 7: [(2, "b"), (3, "k"), (4, "c")]}


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append((r.line_no, r.line))
    return {k: sorted(v) for k, v in out.items()}


def test_sections_of_broken_layouts_are_rejects(frame):
    docs = frame([(k, "a\nb\nk\nc\nz", *v) for k, v in LAYOUTS.items()], f"doc_id bigint, text string, {LAYOUT}")
    cut = S.cut_text(docs)
    assert cut.columns == [*docs.columns, "reason", "section"]
    assert grouped(S.section_rows(cut).collect()) == KEPT
    assert {r.key: r.reason for r in S.section_rejects(cut).collect()} == REASONS


def test_paged_sections_of_broken_layouts_are_rejects(frame):
    layouts = frame([(k, *v) for k, v in LAYOUTS.items()], f"doc_id bigint, {LAYOUT}")
    pages = frame([(k, i, t) for k in LAYOUTS for i, t in enumerate(["a\nb", "k\nc\nz"])],
                  "doc_id bigint, page_no bigint, text string")
    lines, rejected = S.cut_pages(pages, layouts)
    assert grouped(lines.collect()) == KEPT
    assert {r.key: r.reason for r in rejected.collect()} == REASONS


def test_line_steps_keep_lines_of_broken_patterns(frame):
    lines = frame([(1, 1, "h", "("), (1, 2, "h", "("), (2, 1, "h", "h"), (2, 2, "x", "h"), (2, 3, "h", "h"), (3, 1, "q", None)],
                  "doc_id bigint, line_no bigint, line string, p string")
    left = S.without_matching(lines, F.col("p"))
    assert left.columns == lines.columns
    assert sorted((r.doc_id, r.line_no) for r in left.collect()) == [(1, 1), (1, 2), (2, 2), (3, 1)]
    once = S.without_repeats(lines, F.col("p"))
    assert sorted((r.doc_id, r.line_no) for r in once.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)]
    docs = lines.groupBy("doc_id", "p").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("rows"))
    kept = {r.doc_id: [x.line_no for x in r.rows] for r in S.without_repeats_in(docs, "rows", F.col("p")).collect()}
    assert kept == {1: [1, 2], 2: [1, 2], 3: [1]}


PAGE = '<a href="x-Award">1</a><a href="/y-Award">2</a>'


def test_one_broken_source_does_not_stop_the_others(frame):
    index = frame([("A", "http://h/i", PAGE, "Award", "fwd"), ("B", "http://h/i", PAGE, "(", "fwd"),
                   ("C", "http://h/i", PAGE, None, "rev")],
                  "state string, url string, html string, pattern string, order string")
    checked = check_pattern(index)
    assert {r.state: r.latest for r in latest_links(checked).collect()} == {"A": "http://h/y-Award", "B": None, "C": None}
    assert [tuple(r) for r in pattern_rejects(checked).collect()] == [("pattern", "B", "pattern does not compile: (")]


def test_why_a_source_has_no_document(frame):
    pages = frame([("http://h/i", PAGE), ("https://H:443/d/../j?q=%7e", PAGE)], "url string, html string")
    rows = [
        ("A", "HTTP://h:80/i#top", "IDX", "Award", "rev", "HTTP://h:80/x-Award", None),
        ("B", "https://h/j?q=~", "IDX", "Award", "fwd", "https://h/y-Award", None),
        ("C", "http://h/i", "IDX", "[", "fwd", None, "pattern does not compile: ["),
        ("D", "http://h/none", "IDX", "Award", "fwd", None, "no index page"),
        ("E", "http://h/i", "IDX", "pay", "fwd", None, "no matching link"),
        ("F", "http://h/i", "IDX", "", "fwd", None, "no pattern"),
        ("G", "http://h/i", "IDX", "Award", "up", None, "bad order"),
        ("H", None, "WEB", None, "fwd", None, "no address"),
        ("I", None, "IDX", "Award", "fwd", None, "no index page"),
        ("J", "doc", "WEB", "(", None, "doc", None),
    ]
    sources = frame([r[:5] for r in rows], "state string, url string, type string, pattern string, order string")
    resolved = resolve_sources(sources, pages)
    assert {r.state: (r.doc_url, r.reason) for r in resolved.collect()} == {r[0]: r[5:] for r in rows}
    assert {r.key: r.reason for r in source_rejects(resolved).collect()} == {r[0]: r[6] for r in rows if r[6]}


@pytest.mark.parametrize(("url", "key"), [
    ("http://h/x", "http://h/x"), ("HTTP://H:80/x#top", "http://h/x"), ("http://h", "http://h/"),
    ("https://h:443?a=1#b", "https://h/?a=1"), ("http://h:443/", "http://h:443/"), ("http://h:/a", "http://h/a"),
    ("http://Me:Pw@H/a", "http://Me:Pw@h/a"), ("http://h/a/./b/../c/..", "http://h/a/"), ("http://h/%7Eme/%c3%a9%2f%zz%", "http://h/~me/%C3%A9%2F%zz%"),
    ("http://h/A?B=%41%20", "http://h/A?B=A%20"), (" http://h/x ", "http://h/x"), ("mailto:A@b#c", "mailto:A@b"), ("", ""), (None, None),
    ("http://[::1]:80/x", "http://[::1]/x"), ("http://h/a?x=../b", "http://h/a?x=../b"), ("http://h/a%2e%2E/b", "http://h/a../b"),
])
def test_url_key(one, url, key):
    assert one(url_key(F.lit(url).cast("string"))) == key

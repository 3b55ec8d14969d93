from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from rategrid import schemas
from rategrid.functions.text import numbered, split_lines
from rategrid.operators import sections as S
from rategrid.operators.combine import combine_states, with_layouts
from rategrid.operators.extract import extract_rejects, extract_tables, extracted_rows
from rategrid.sources.literal import DEFAULT_LAYOUTS, ROADS_LAYOUT, literal_table

LAYOUT_DDL = ("start_pattern string, start_offset int, end_pattern string, end_offset int, "
              "skip_pattern string")


def brute_cut(text, start, start_offset, end, end_offset, skip):
    """The rules, written out for one document."""
    lines = text.split("\n")

    def last(pattern, default):
        if pattern == "":
            return default
        hits = [i for i, line in enumerate(lines, 1) if re.search(pattern, line)]
        return hits[-1] if hits else None

    if start is None or end is None:
        return "no_layout"
    first, stop = last(start, 1), last(end, len(lines))
    if first is None:
        return "no_start"
    if stop is None:
        return "no_end"
    first, stop = first + start_offset, stop + end_offset
    if stop < first:
        return "end_before_start"
    if stop < 1 or first > len(lines):
        return "outside_document"
    return [
        (i, lines[i - 1]) for i in range(max(first, 1), min(stop, len(lines)) + 1)
        if not (skip and re.search(skip, lines[i - 1])) and lines[i - 1].strip()
    ]


TEXT = "PART B 1\nintro\nPART B\ntitle\n a  1\n   7\n\n b  2\nPART C\ntail"
CASES = [
    ("PART B", 2, "PART C", -1, r"^\s+\d+$"), ("", 0, "", 0, ""), ("", -5, "", 5, "^ "),
    ("PART X", 0, "PART C", 0, ""), ("PART B", 0, "PART X", 0, ""), ("PART C", 0, "PART B", 0, ""),
    ("PART C", 9, "", 9, ""), ("", 0, "PART B", -9, ""), (None, None, None, None, None),
    ("PART C", 0, "PART C", 0, None), ("^tail$", 0, "", 0, ""), ("", -9, "", -10, ""),
]


def found_cuts(docs):
    cut = S.cut_text(docs)
    rows: dict = {}
    for r in S.section_rows(cut).orderBy("doc_id", "line_no").collect():
        rows.setdefault(r.doc_id, []).append((r.line_no, r.line))
    reasons = {int(r.key): r.reason for r in S.section_rejects(cut).collect()}
    return rows, reasons


def test_cut_text(frame):
    docs = frame([(i, TEXT, *case) for i, case in enumerate(CASES)],
                 "doc_id bigint, text string, " + LAYOUT_DDL)
    rows, reasons = found_cuts(docs)
    for i, case in enumerate(CASES):
        wanted = brute_cut(TEXT, *case)
        assert (reasons.get(i) or rows.get(i, [])) == wanted, case


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_cut_pages_equals_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(S, "PAGE_BLOCK", block)
    rng = random.Random(block)
    words = ["PART B", "PART C", "  12", "", " a  1", "b", "PART B 3"]
    pages, layouts, wanted = [], [], {}
    for doc in range(60):
        texts = ["\n".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 9))]
        case = CASES[doc % len(CASES)]
        numbers = sorted(rng.sample(range(20), len(texts)))
        pages += [(doc, n, text) for n, text in zip(numbers, texts, strict=True)]
        layouts.append((doc, *case))
        wanted[doc] = brute_cut("\n".join(texts), *case)
    lines, rejects = S.cut_pages(
        frame(pages, "doc_id bigint, page_no bigint, text string"),
        frame(layouts, "doc_id bigint, " + LAYOUT_DDL))
    rows: dict = {}
    for r in lines.orderBy("doc_id", "line_no").collect():
        rows.setdefault(r.doc_id, []).append((r.line_no, r.line))
    reasons = {int(r.key): r.reason for r in rejects.collect()}
    for doc, want in wanted.items():
        assert (reasons.get(doc) or rows.get(doc, [])) == want


def test_document_without_layout_row_is_rejected(frame):
    pages = frame([(1, 1, "x")], "doc_id bigint, page_no bigint, text string")
    layouts = frame([(2, "", 0, "", 0, "")], "doc_id bigint, " + LAYOUT_DDL)
    lines, rejects = S.cut_pages(pages, layouts)
    assert lines.count() == 0
    assert [tuple(r) for r in rejects.collect()] == [("section", "1", "no_layout")]


def lines_frame(frame, *lines):
    return frame([(1, i, line) for i, line in enumerate(lines, 1)],
                 "doc_id int, line_no int, line string")


def test_repeated_headings(frame):
    lines = lines_frame(frame, "a", "H 1", "b", "H 2", "H 3")
    kept = [r.line for r in S.without_repeats(lines, "^H").orderBy("line_no").collect()]
    assert kept == ["a", "H 1", "b"]
    none = S.without_repeats(lines, "^X")  # nothing repeated: everything stays
    assert none.count() == 5
    docs = frame([("a\nH 1\nH 2\nb",), ("a\nb",)], "text string").select(
        numbered(split_lines(F.col("text"))).alias("rows"))
    found = [[x.line for x in r.rows] for r in S.without_repeats_in(docs, "rows", "^H").collect()]
    assert found == [["a", "H 1", "b"], ["a", "b"]]


def test_blank_and_matching_lines(frame):
    lines = lines_frame(frame, " a ", "  ", "", "b", "  3")
    assert [r.line for r in S.without_blank(lines, trim=True).orderBy("line_no").collect()] == ["a", "b", "3"]
    assert S.without_matching(lines, r"^\s+\d+$").count() == 4
    assert S.without_matching(lines, "").count() == 5
    assert [r.line for r in S.only_matching(lines, "b").collect()] == ["b"]
    assert S.last_matching_line(lines, "b").first().last_line == 4
    assert S.last_matching_line(lines, "zz").first().last_line is None


def test_head(frame):
    rows = frame([("a\nb\nc",)], "text string").select(numbered(split_lines(F.col("text"))).alias("r"))
    take = lambda c: [x.line for x in rows.select(c.alias("x")).first().x]
    assert take(S.head(F.col("r"), 2)) == ["a", "b"] and take(S.head(F.col("r"), 9)) == ["a", "b", "c"]
    assert take(S.after_head(F.col("r"), 2)) == ["c"] and take(S.after_head(F.col("r"), 9)) == []


def test_text_check(frame):
    pages = frame([(1, "x" * 15, 2), (1, "x" * 16, 2), (2, None, 2), (2, "short", 2), (3, "y" * 99, 2)],
                  "doc_id int, text string, pages_expected int")
    found = {r.doc_id: (r.has_text, r.pages_read, r.complete) for r in S.text_check(pages).collect()}
    assert found == {1: (True, 2, True), 2: (False, 2, True), 3: (True, 1, False)}


def test_default_layouts(spark, frame):
    layouts = literal_table(spark, DEFAULT_LAYOUTS + ROADS_LAYOUT, schemas.LAYOUTS)
    sources = frame([("WA",), ("Qld",), ("SA",), ("NT",)], "state string")
    joined = with_layouts(sources, layouts)
    found = {r.state: r.start_pattern for r in joined.collect()}
    assert found == {"WA": "SALARIES – PROFESSIONAL DIVISION", "Qld": None, "SA": None, "NT": None}
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    text = ("SALARIES – PROFESSIONAL DIVISION .... 9\nSALARIES – PROFESSIONAL DIVISION\nfrom 2022\n"
            "Level  Pay\n P1  100\n  12\n P2  200\n\nend\nSCHEDULE 3")
    docs = with_layouts(frame([("WA", 1, text)], "state string, doc_id int, text string"), layouts)
    assert [r.line for r in S.section_rows(S.cut_text(docs)).collect()] == ["Level  Pay", " P1  100", " P2  200"]


def test_extract_tables(frame):
    html = "<table><tr><td>a</td></tr></table><table><tr><td>b</td><td>c</td></tr></table>"
    text = "RATES\n x  1\nEND"
    docs = frame(
        [(1, "HTML", html, None), (2, "pdf", None, text), (3, "scan.pdf", None, None),
         (4, "docx", None, None), (5, None, None, None), (6, "html", "<p>", None),
         (7, "pdf", None, "nothing")],
        "doc_id int, doc_type string, html string, text string",
    ).withColumn("order", F.lit("fwd"))
    extracted = extract_tables(docs, S.layout_literals("^RATES", 1, "^END", -1, ""))
    rows = {(r.doc_id, r.route): r.cells for r in extracted_rows(extracted).collect()}
    assert rows == {(1, "html"): ["b", "c"], (2, "pdf"): [" x", "1"]}
    rejects = {r.key: (r.stage, r.reason) for r in extract_rejects(extracted).collect()}
    assert rejects == {
        "3": ("doc_type", "scanned document"), "4": ("doc_type", "unknown type: docx"),
        "5": ("doc_type", "unknown type: NULL"), "6": ("html", "no table"), "7": ("pdf", "no_start")}


def test_combine_states(frame):
    both = combine_states({"A": frame([(1, "x")], "n int, a string"),
                           "B": frame([("y", 2)], "b string, n int")})
    assert sorted((r.state, r.n, r.a, r.b) for r in both.collect()) == [
        ("A", 1, "x", None), ("B", 2, None, "y")]

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rategrid.operators.columns import (
    cut_widths,
    generated_names,
    guess_types,
    infer_widths,
    padded_cells,
    repair_ocr,
    sample_lines,
    separate,
    split_mixed,
    split_ocr,
    split_wide,
    text_cells,
    text_columns,
    to_wide,
    unique_names,
)


@pytest.mark.parametrize(
    ("line", "cells"),
    [
        ("  L1  Per Week   1,200", ["", "L1", "Per Week", "1,200"]),
        ("a b", ["a b"]),
        ("a|b  c", ["a", "b", "c"]),
        ("a  b", ["a", "b"]),
        ("a  ", ["a", ""]),
        ("", [""]),
    ],
)
def test_split_wide(one, line, cells):
    assert one(split_wide(F.lit(line))) == cells


def test_split_mixed(one):
    assert one(split_mixed(F.lit("Year 5 and thereafter  104,345\t106,985"))) == [
        "Year 5 and thereafter", "104,345", "106,985"]


def test_separate(frame):
    lines = frame([("a  b  1  2  3  4",), ("a  b",)], "line string")
    names = ["class", "frequency", "pay1", "pay2"]
    assert [tuple(r) for r in lines.select(*separate(F.col("line"), names)).collect()] == [
        ("a", "b", "1", "2"), ("a", "b", None, None)]
    merged = lines.select(*separate(F.col("line"), [*names, "more"], merge_rest=True))
    assert [r.more for r in merged.collect()] == ["3|4", None]


def test_padding_is_per_table(frame):
    rows = frame([(1, 1, ["a"]), (1, 2, ["b", "c", "d"]), (2, 1, ["e"])],
                 "doc_id int, row_no int, cells array<string>")
    found = padded_cells(rows, ["doc_id"])
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, 1, 0, "a"), (1, 1, 1, ""), (1, 1, 2, ""), (1, 2, 0, "b"), (1, 2, 1, "c"), (1, 2, 2, "d"),
        (2, 1, 0, "e")]


def test_names(frame):
    assert unique_names(["Pay", "", "Pay", "x", None]) == ["Pay...1", "...2", "Pay...3", "x", "...5"]
    assert generated_names(3) == ["c1", "c2", "c3"]
    rows = frame([(1, ["a", "b"])], "id int, cells array<string>")
    assert to_wide(rows, ["p", "p", "q"], ["id"]).first().asDict() == {
        "id": 1, "p...1": "a", "p...2": "b", "q": None}


FIXED = ["  Level   Pay   Year", "  P1      100   2020", "  P 2    1000   2021 x", "", "   longer  2,000 2022"]


def fixed_lines(frame, lines=FIXED, doc=1):
    return frame([(doc, i, line) for i, line in enumerate(lines, 1)],
                 "doc_id int, line_no int, line string")


def test_fixed_widths(frame):
    lines = fixed_lines(frame)
    widths = infer_widths(sample_lines(lines, ["doc_id"], 1, 3), ["doc_id"])
    spec = sorted(tuple(r) for r in widths.drop("doc_id", "seen").collect())
    # "P 2" leaves no gap, because other sample lines fill it.
    assert spec == [(0, 2, 7), (1, 9, 13), (2, 16, 20), (3, 21, None)]
    cells = cut_widths(lines, widths, ["doc_id"])
    found = {}
    for r in cells.orderBy("line_no", "col_no").collect():
        found.setdefault((r.line_no, r.truncated), []).append(r.cell)
    assert found == {
        (1, False): ["Level", "Pay", "Year", ""],
        (2, False): ["P1", "100", "2020", ""],
        (3, False): ["P 2", "1000", "2021", "x"],
        (4, False): ["", "", "", ""],
        (5, True): ["long", "2,", "202", ""],
    }


def test_columns_that_begin_late(frame):
    lines = fixed_lines(frame, ["ab  cd"] * 20 + ["ab  cd  ef", "ab  cdefg"])
    sampled = infer_widths(sample_lines(lines, ["doc_id"], 1, 20), ["doc_id"])
    cells = cut_widths(lines, sampled, ["doc_id"]).where("line_no > 19").orderBy("line_no", "col_no")
    # Two columns in one cell are marked; a longer last cell is not.
    assert [(r.line_no, r.truncated, r.cell) for r in cells.collect() if r.col_no == 1] == [
        (20, False, "cd"), (21, True, "cd  ef"), (22, False, "cdefg")]
    lines = fixed_lines(frame, ["ab  cd"] * 20 + ["ab  cd  ef"])
    cells = cut_widths(lines, infer_widths(lines, ["doc_id"]), ["doc_id"])
    assert [(r.truncated, r.cell) for r in cells.where("line_no = 21").orderBy("col_no").collect()] == [
        (False, "ab"), (False, "cd"), (False, "ef")]


def test_table_of_empty_rows(frame):
    rows = frame([(1, 0, []), (1, 1, []), (None, 0, ["a"]), (None, 1, ["b", "c"])],
                 "doc_id int, row_no int, cells array<string>")
    found = sorted(((r.row_no, r.col_no, r.cell) for r in padded_cells(rows, ["doc_id"]).collect()))
    assert found == [(0, 0, "a"), (0, 1, ""), (1, 0, "b"), (1, 1, "c")]


def test_sample_of_a_short_document(frame):
    """Lines 10 to 20, or the last line when there are fewer than ten."""
    short = fixed_lines(frame, ["x"] * 4)
    assert [r.line_no for r in sample_lines(short, ["doc_id"], 10, 20, clip=True).collect()] == [4]
    long = fixed_lines(frame, ["x"] * 30)
    picked = sample_lines(long, ["doc_id"], 10, 20, clip=True).collect()
    assert sorted(r.line_no for r in picked) == list(range(10, 21))


@pytest.mark.parametrize(
    ("line", "repaired", "cells"),
    [
        ("AHP1-1 $ 50000 x $51000", "AHP1-1 | $50000 x $51000", ["AHP1-1", "$50000", "$51000"]),
        ("Level 2 $1,000 $ 2,000", "Level 2 $1,000 $2,000", ["Level 2", "$1,000", "$2,000"]),
        ("no amounts", "no amounts", ["no amounts"]),
        ("a|b", "a|b", ["a", "b"]),
    ],
)
def test_ocr(one, line, repaired, cells):
    assert one(repair_ocr(F.lit(line))) == repaired
    found = one(split_ocr(F.lit(repaired)))
    assert [c.strip() for c in found] == cells


TYPED = {
    "logical": ["T", "FALSE", "", "NA", "true"],
    "integer": ["1", "-20", " 3 ", "2000000000", "9223372036854775807"],
    "double": ["1", "2.5", "-1e3", ".5", "9223372036854775808"],
    "number": ["1,234", "567", "1,234,567.5"],
    "time": ["9:30", "23:59:59"],
    "date": ["2020-02-01", "2021/12/31"],
    "datetime": ["2020-02-01T10:00:00Z", "2020-02-01 10:00"],
}
TEXT = {"zeros": ["007", "1"], "mixed": ["1", "x"], "dollars": ["$1,000", "2"], "commas": ["12,34"]}


def typed_cells(frame):
    rows = []
    for column, values in {**TYPED, **TEXT, "empty": ["", None, "NA"]}.items():
        rows += [(1, i, column, v) for i, v in enumerate(values)]
    return frame(rows, "doc_id int, row_no int, col_no string, cell string")


def test_guess_types(frame):
    found = {r.col_no: r.type for r in guess_types(typed_cells(frame), ["doc_id", "col_no"]).collect()}
    wanted = {name: name for name in TYPED} | {name: "character" for name in TEXT} | {"empty": "logical"}
    assert found == wanted


def test_text_cells(frame):
    found = text_cells(typed_cells(frame), ["doc_id"])
    assert {r.col_no for r in found.collect()} == set(TEXT)
    assert text_columns(frame([(1, "a", 2.0)], "n int, s string, d double")).columns == ["s"]

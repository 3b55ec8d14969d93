"""Typed values, cells of long lines, bit maps of positions, and levels of text."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from rategrid.functions import blocks
from rategrid.functions.ordinals import with_ordinals
from rategrid.operators.bands import ordered_levels
from rategrid.operators.columns import VALUE_FIELDS, infer_widths, typed_cells, typed_value
from rategrid.operators.wordgrid import (
    cell_rows,
    glued_cells,
    line_cells,
    placed_words,
    text_lines,
    word_cells,
    word_table,
)


@pytest.mark.parametrize(("kind", "cell", "field", "value"), [
    ("logical", "T", "logical", True), ("logical", " false ", "logical", False), ("integer", "+7", "integer", 7),
    ("integer", "-12", "integer", -12), ("double", "1e3", "double", 1000.0), ("double", ".5", "double", 0.5),
    ("double", "7", "double", 7.0), ("number", "1,234,567.5", "double", 1234567.5), ("number", "-12", "double", -12.0),
    ("time", "9:30", "seconds", 34200), ("time", "23:59:58", "seconds", 86398),
    ("date", "2020-2-9", "date", datetime.date(2020, 2, 9)), ("date", "2020/12/31", "date", datetime.date(2020, 12, 31)),
    ("date", "2020-02-30", None, None), ("datetime", "2020-02-03T04:05:06.5Z", "datetime", datetime.datetime(2020, 2, 3, 4, 5, 6, 500000)),
    ("datetime", "2020-02-03 04:05", "datetime", datetime.datetime(2020, 2, 3, 4, 5)),
    ("character", " x ", "text", " x "), ("character", "NA", "text", "NA"), ("integer", "NA", None, None),
    ("logical", "", None, None), ("date", None, None, None), (None, "x", None, None),
])
def test_typed_value(one, kind, cell, field, value):
    found = one(typed_value(F.lit(cell).cast("string"), F.lit(kind).cast("string")))
    assert list(found.asDict()) == VALUE_FIELDS
    assert found.asDict() == {f: value if f == field else None for f in VALUE_FIELDS}


def test_types_hold_for_the_whole_column(frame, monkeypatch):
    rows = [(1, i, 0, str(i)) for i in range(50)] + [(1, i, 1, "x" if i == 49 else str(i)) for i in range(50)] + [
        (None, 0, 0, "2020-01-01"), (None, 1, 0, "NA"), (2, 0, 0, "1,000"), (2, 1, 0, "5")]
    cells = frame(rows, "doc_id int, row_no bigint, col_no int, cell string")
    found = {(r.doc_id, r.row_no, r.col_no): (r.type, r.value) for r in typed_cells(cells, ["doc_id"]).collect()}
    assert len(found) == len(rows)
    assert found[1, 48, 0][0] == "integer" and found[1, 48, 0][1].integer == 48
    assert found[1, 48, 1][0] == "character" and found[1, 48, 1][1].text == "48"
    assert found[None, 0, 0][1].date == datetime.date(2020, 1, 1) and found[None, 1, 0][0] == "date"
    assert found[2, 0, 0][1].double == 1000.0 and found[2, 1, 0][1].double == 5.0


SCHEMA = "doc_id bigint, page_no bigint, x int, y bigint, text string, space boolean"


def random_words(rng):
    rows = []
    for doc in (1, 2, None):
        for y in sorted(rng.sample(range(100), rng.randint(1, 6))):
            for x in rng.choices(range(60), k=rng.randint(1, 9)):
                rows.append((doc, rng.randint(1, 2), x, y, rng.choice(["a", "b", " c", None, ""]), rng.choice([True, False, None])))
    return rows


@pytest.mark.parametrize("block", [1, 7, 16384])
def test_cells_of_words_equal_cells_of_lines(frame, monkeypatch, block):
    monkeypatch.setattr(blocks.place, "__kwdefaults__", {**blocks.place.__kwdefaults__, "block_rows": block})
    rng = random.Random(block)
    for _ in range(4):
        words = frame(random_words(rng), SCHEMA)
        long = line_cells(placed_words(words)).collect()
        lines = text_lines(words).select("doc_id", "page_no", "y", F.posexplode(glued_cells(F.col("words"))).alias("col_no", "cell"))
        key = lambda r: tuple(r)
        assert sorted(map(key, long), key=repr) == sorted(map(key, lines.collect()), key=repr)


def test_rows_of_cells_equal_the_table(frame):
    rng = random.Random(5)
    for remove_last in (True, False):
        # One x for each word of a line: a header of two words at one place has no order.
        rows = list({(r[0], r[1], r[2], r[3]): r for r in random_words(rng)}.values())
        words = frame(rows, SCHEMA)
        long = cell_rows(words, remove_last).collect()
        table = word_cells(word_table(words, remove_last)).collect()
        assert sorted(map(tuple, long), key=repr) == sorted(map(tuple, table), key=repr)


def test_a_page_of_one_line(frame, spark):
    n = 40_000
    words = spark.range(n).select(
        F.lit(1).cast("bigint").alias("doc_id"), F.lit(1).cast("bigint").alias("page_no"),
        (F.col("id") * 3).cast("int").alias("x"), F.lit(5).cast("bigint").alias("y"),
        F.col("id").cast("string").alias("text"), (F.col("id") % 3 != 2).alias("space"),
    )
    found = line_cells(placed_words(words))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    gathers = [line for line in plan.splitlines() if "collect_list" in line]
    assert gathers and all("col_no" in line.split("]")[0] for line in gathers)
    cells = {r.col_no: r.cell for r in found.collect()}
    assert len(cells) == n // 3 + 1 and cells[0] == "0 1 2" and cells[n // 3] == str(n - 1)


def brute_widths(lines):
    used = sorted({i for line in lines for i, c in enumerate(line) if not c.isspace()})
    runs = []
    for i in used:
        if runs and runs[-1][1] == i:
            runs[-1][1] = i + 1
        else:
            runs.append([i, i + 1])
    return [(n, b, None if n == len(runs) - 1 else e, e) for n, (b, e) in enumerate(runs)]


def test_widths_of_long_lines(frame):
    rng = random.Random(2)
    docs = {d: ["".join(rng.choice("ab é\U0001f600   ") if rng.random() < 0.3 else " " for _ in range(rng.choice([0, 1, 63, 64, 65, 128, 300])))
                for _ in range(rng.randint(1, 3))] for d in range(40)}
    docs[99] = ["x" * 64, "y" * 128 + " " + "z" * 63, ""]
    lines = frame([(d, i, t) for d, ls in docs.items() for i, t in enumerate(ls)], "doc_id int, line_no int, line string")
    found = {}
    for r in infer_widths(lines, ["doc_id"]).collect():
        found.setdefault(r.doc_id, []).append((r.col_no, r.begin, r.end, r.seen))
    assert {d: sorted(v) for d, v in found.items()} == {d: w for d, ls in docs.items() if (w := brute_widths(ls))}


def test_one_row_a_line_and_64_positions(frame):
    lines = frame([(1, 1, "x" * 500)] * 10, "doc_id int, line_no int, line string")
    plan = infer_widths(lines, ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan


def test_levels_of_text_by_locale(frame):
    rows = frame([(t,) for t in ["Z", "a", "A", "b", "é", "e", "f", "z", "a", None]], "level string")
    order = lambda c: [r.level for r in ordered_levels(rows, "level", c).orderBy("ordinal").collect()]
    assert order(None) == ["A", "Z", "a", "b", "e", "f", "z", "é"]
    assert order("UNICODE") == ["a", "A", "b", "e", "é", "f", "z", "Z"]
    # Equal under the collation: bytes decide, and every level keeps its own ordinal.
    assert order("UNICODE_CI_AI") == ["A", "a", "b", "e", "é", "f", "Z", "z"]
    counted = {r.level: (r.ordinal, r.n) for r in ordered_levels(rows, "level", "de").collect()}
    assert counted["a"] == (1, 2) and sorted(o for o, _ in counted.values()) == list(range(1, 9))


def test_many_levels_in_ranges(frame):
    rng = random.Random(1)
    texts = sorted({"".join(rng.choices("abcABCxyz", k=4)) for _ in range(400)})
    levels = frame([(t, 1) for t in texts], "level string, n bigint")
    found = {r.level: r.ordinal for r in with_ordinals(levels, splits=9, collation="UNICODE").collect()}
    wanted = sorted(texts, key=lambda t: (t.lower(), [c.isupper() for c in t]))
    assert found == {t: i for i, t in enumerate(wanted, 1)}

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from rategrid.operators.faults import worked
from rategrid.operators.rates import (
    carry_heading,
    clean_pay_points,
    crosswalk_rejects,
    effective_date,
    header_labels,
    sheet_rates,
    to_common_band,
)
from rategrid.operators.wordgrid import glued_cells, word_cells, word_columns, word_table

WORDS = [
    # y, x, text, space
    (10, 0, "Pay", True), (10, 9, "Year", False),
    (20, 0, "Level", True), (20, 5, "one", False), (20, 20, "100", False), (20, 30, "2020", False),
    (30, 30, "2021", False), (30, 20, "200", False),
    (40, 0, "x", False), (40, 5, "TRUE", True), (40, 6, "FALSE", False), (40, 20, "300", False),
    (40, 30, "2022", True),
    (50, 0, "end", False),
]


@pytest.fixture
def words(frame):
    rows = [(1, 1, x, y, t, s) for y, x, t, s in WORDS] + [(1, 2, 0, 5, "only", False)]
    return frame(rows, "doc_id bigint, page_no bigint, x int, y bigint, text string, space boolean")


def cells(table):
    out = {}
    for r in word_cells(table).orderBy("page_no", "row_no", "col_no").collect():
        out.setdefault((r.page_no, r.row_no), []).append((r.header, r.cell))
    return out


def test_word_table(words):
    assert cells(word_table(words)) == {
        (1, 1): [("label", "Level one"), ("Pay", "100"), ("Year", "2020")],
        (1, 2): [("Pay", "200"), ("Year", "2021")],
        # One cell too many: no header. Words that spell a flag stay words.
        (1, 3): [(None, "x"), ("label", "TRUE FALSE"), ("Pay", "300"), ("Year", "2022")],
    }


def test_last_line_is_kept_on_request(words):
    table = word_table(words, remove_last=False)
    assert cells(table)[(1, 4)] == [("Year", "end")]
    assert table.where("page_no = 2").count() == 0  # a page with a header only


def test_word_columns(words):
    wide = word_columns(word_table(words), ["Pay", "Year", "None"]).orderBy("row_no").collect()
    assert [(r.label, r.Pay, r.Year, r["None"]) for r in wide] == [
        ("Level one", "100", "2020", None), (None, "200", "2021", None), ("TRUE FALSE", "300", "2022", None)]


def test_open_cell_at_the_end(frame):
    line = frame([([(0, "a", True), (1, "b", None), (2, "c", True)],)],
                 "words array<struct<x: int, text: string, space: boolean>>")
    assert line.select(glued_cells(F.col("words")).alias("c")).first().c == ["a b", "c"]


SHEET = """Specified calling level\t2019 Salary Rates\t2020-02-01\t2021-02-01
LEVEL 1
1st year\t68,793\t69,793\t70,793
2nd year\t72,310\t73,310\t74,310

LEVEL4
4.1\t126,927\t127,927\t128,927
LEVEL 7\t186,121\t187,121\t188,121
Senior Specialist (-4%) #
Year 5 and thereafter  104,345\t106,985
Note:
* Reduced by 10%"""


def sheet(frame, text=SHEET):
    return frame([(1, i, line) for i, line in enumerate(text.split("\n"), 1)],
                 "doc_id int, line_no int, line string")


def test_headings(frame):
    steps = carry_heading(sheet(frame), header_line=1).orderBy("line_no").collect()
    assert [(r.line_no, r.heading, r.step) for r in steps] == [
        (3, "LEVEL 1", "1st year"), (4, "LEVEL 1", "2nd year"), (7, "LEVEL4", "4.1"),
        (8, "LEVEL 7", "LEVEL 7"), (10, "Senior Specialist (-4%)", "Year 5 and thereafter")]


def test_titles_below_a_grade(frame):
    text = "Pharmacist\nGrade 3\nDirector\nDeputy\n1st Year\t2,315.39\nGrade 4\n2nd Year\t2,460.54"
    steps = carry_heading(sheet(frame, text)).orderBy("line_no").collect()
    assert [(r.section, r.heading, r.step, r.labels) for r in steps] == [
        ("Grade 3", "Deputy", "1st Year", None), ("Grade 4", "Grade 4", "2nd Year", None)]


def test_rates(frame):
    rates = sheet_rates(sheet(frame)).where("line_no in (3, 10)").orderBy("line_no", "col_no").collect()
    date = datetime.date
    assert [(r.step, r.col_no, r.effective_label, r.effective, r.rate) for r in rates] == [
        ("1st year", 1, "2019 Salary Rates", None, 68793.0),
        ("1st year", 2, "2020-02-01", date(2020, 2, 1), 69793.0),
        ("1st year", 3, "2021-02-01", date(2021, 2, 1), 70793.0),
        ("Year 5 and thereafter", 1, "2019 Salary Rates", None, 104345.0),
        ("Year 5 and thereafter", 2, "2020-02-01", date(2020, 2, 1), 106985.0)]


def test_steps_without_amounts(frame):
    text = "Level\t2020-02-01\t2021-02-01\nLEVEL 1\n1st Year\tnegotiable\tnegotiable\n2nd Year\t5\t\nSenior\n3rd Year\t\t7"
    steps = carry_heading(sheet(frame, text), header_line=1).orderBy("line_no").collect()
    assert [(r.heading, r.step) for r in steps] == [
        ("LEVEL 1", "1st Year"), ("LEVEL 1", "2nd Year"), ("Senior", "3rd Year")]
    rates = sheet_rates(sheet(frame, text)).orderBy("line_no", "col_no").collect()
    assert [(r.step, r.col_no, r.rate, r.reason) for r in rates] == [
        ("1st Year", 1, None, "no amount: negotiable"), ("1st Year", 2, None, "no amount: negotiable"),
        ("2nd Year", 1, 5.0, None), ("3rd Year", 2, 7.0, None)]


def test_header_cell_for_two_columns(one):
    labels = header_labels(F.array(F.lit("Classification"), F.lit("current 2022-07-01")))
    assert one(labels) == ["Classification", "current", "2022-07-01"]
    assert one(effective_date(F.lit("01/07/2022"))) == datetime.date(2022, 7, 1)
    assert one(effective_date(F.lit("current"))) is None
    assert one(effective_date(F.lit("2022-99-01"))) is None


def test_crosswalk(frame):
    salaries = frame([("WA", "P-1.2", 1.0), ("WA", "P-9 *", 2.0), ("Qld", "P-1.2", 3.0)],
                     "state string, level string, annual double")
    crosswalk = frame([("WA", "P-1.2", 1), ("WA", "P-9", 6)], "state string, level string, band int")
    banded = to_common_band(salaries, crosswalk)
    assert sorted((r.level, r.band) for r in worked(banded).collect()) == [("P-1.2", 1), ("P-9", 6)]
    rejected = crosswalk_rejects(banded)
    assert [tuple(r) for r in rejected.collect()] == [("crosswalk", "Qld/P-1.2", "no band")]


def test_pay_points(frame):
    rows = frame([(1, "31"), (2, " "), (3, None), (4, "5 #")], "id int, p string")
    assert sorted(tuple(r) for r in clean_pay_points(rows, "p").collect()) == [(1, "3"), (4, "5")]
    marks = clean_pay_points(rows, "p", digits=False)
    assert sorted(tuple(r) for r in marks.collect()) == [(1, "31"), (4, "5")]

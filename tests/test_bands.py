from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rategrid import schemas
from rategrid.functions.money import dollar_label, is_money, money_to_double, strip_footnote_digit
from rategrid.operators.bands import (
    below_level,
    clean_salaries,
    covered_ticks,
    ordered_levels,
    overlap_join,
    overlap_ranges,
    salary_bands,
)
from rategrid.sources.readers import read_csv

# Known bands: state, band, lowest, highest pay.
GOLDEN = {
    ("NSW", 1): (68216, 88011), ("NSW", 2): (93469, 102511), ("NSW", 3): (108229, 119390),
    ("NSW", 4): (124705, 131953), ("NSW", 5): (137424, 140007), ("NSW", 6): (142616, 145253),
    ("Qld", 1): (75844, 101751), ("Qld", 2): (112241, 120780), ("Qld", 3): (126974, 132489),
    ("Qld", 4): (141467, 146439), ("Qld", 5): (161151, 172698), ("Qld", 6): (178959, 218879),
    ("Vic", 1): (71930, 84853), ("Vic", 2): (89369, 95491), ("Vic", 3): (103413, 112011),
    ("Vic", 4): (119893, 135149), ("WA", 1): (78909, 103257), ("WA", 2): (105824, 112443),
    ("WA", 3): (117368, 121402), ("WA", 4): (127938, 132198), ("WA", 5): (136870, 144623),
    ("WA", 6): (150626, 156736), ("WA", 7): (165664, 165664), ("WA", 8): (171344, 171344),
    ("WA", 9): (177819, 177819), ("WA", 10): (187612, 187612), ("WA", 11): (197406, 197406),
    ("WA", 12): (207195, 207195), ("WA", 13): (216985, 216985),
}


@pytest.fixture
def salary_file(spark, tmp_path):
    """The golden bands as a salary file: BOM, CRLF, padded levels, quoted money.

    Amounts between the two ends are there as well, and the rows in no order.
    """
    rng, rows = random.Random(11), []
    for (state, band), (lo, hi) in GOLDEN.items():
        rows.append(f'{state}, {band}.1 ," ${lo:,} ",{band}')
        rows.append(f'{state}, {band}.2 ," ${hi:,} ",{band}')
        rows += [f'{state}, {band}.3 ," ${rng.randint(lo, hi):,} ",{band}' for _ in range(3)]
    rng.shuffle(rows)
    lines = ["state,level,annual,band", *rows]
    path = tmp_path / "salaries.csv"
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join(lines).encode() + b"\r\n")
    return read_csv(spark, str(path), schemas.SALARIES_RAW)


def test_golden_bands(salary_file):
    assert salary_file.where("level = '1.1'").count() == 4  # blanks around levels are gone
    bands = salary_bands(clean_salaries(salary_file))
    assert {(r.state, r.band): (r.lo, r.hi) for r in bands.collect()} == GOLDEN
    five = salary_bands(clean_salaries(below_level(salary_file, "band", 6)))
    assert five.count() == 19


def test_filter_after_aggregate_reaches_the_scan(spark, tmp_path, salary_file):
    path = str(tmp_path / "s.parquet")
    salary_file.write.parquet(path)
    raw = spark.read.parquet(path)
    plan = below_level(salary_bands(clean_salaries(raw)), "band", 6, levels=raw)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(band,6)" in text


MONEY = [
    (" $78,909 ", 78909.0), ("1,307.96", 1307.96), ("-5", -5.0), ("$ 1 2", 12.0),
    ("\u00a0$9\u2003", 9.0), ("12d", None), ("NaN", None), ("0x1F", None), ("1e5", None),
    ("- $1.5 0", -1.5), ("1.2.3", None), ("1-2", None), ("$", None), ("", None), ("n/a", None), (None, None), (".5", None), ("5.", None),
]


def test_money(frame):
    found = frame(MONEY, "text string, value double").select(
        "text", "value", money_to_double(F.col("text")).alias("found"))
    assert [r.text for r in found.collect() if r.found != r.value] == []
    seen = frame(MONEY, "text string, value double").where(is_money(F.col("text")))
    assert [r.value for r in seen.collect()] == [v for _, v in MONEY if v is not None]


def test_dollar_label(one):
    assert one(dollar_label(F.lit(180000))) == "$180,000"


def test_footnotes(one):
    assert one(strip_footnote_digit(F.lit(" 31"))) == "3"
    assert one(strip_footnote_digit(F.lit("4 *^"))) == "4"
    assert one(strip_footnote_digit(F.lit("HP3"))) == "HP3"


def test_unknown_amounts(frame):
    rows = frame([("A", 1, 1.0), ("A", 1, None), ("A", 2, 3.0), ("B", 1, None)],
                 "state string, band int, annual double")
    propagated = {(r.state, r.band): r.lo for r in salary_bands(rows).collect()}
    assert propagated == {("A", 1): None, ("A", 2): 3.0, ("B", 1): None}
    ignored = {(r.state, r.band): r.lo for r in salary_bands(rows, na="ignore").collect()}
    assert ignored == {("A", 1): 1.0, ("A", 2): 3.0, ("B", 1): None}
    with pytest.raises(ValueError):
        salary_bands(rows, na="drop")


def test_unknown_threshold_leaves_nothing(frame):
    rows = frame([(1,), (2,), (4,)], "band int")
    assert below_level(rows, "band", 4).count() == 2
    assert below_level(rows, "band", 3).count() == 0


def test_ordinals_of_many_levels(spark):
    values = random.Random(1).sample(range(100000), 3000)
    rows = spark.createDataFrame([(f"v{v}",) for v in values for _ in range(2)], "level string")
    found = {r.level: (r.ordinal, r.n) for r in ordered_levels(rows, "level").collect()}
    wanted = {v: (i, 2) for i, v in enumerate(sorted(f"v{v}" for v in values), start=1)}
    assert found == wanted


def test_missing_levels_have_no_ordinal(frame):
    rows = frame([("b",), (None,), ("a",), ("b",)], "level string")
    found = ordered_levels(rows, "level").orderBy("ordinal").collect()
    assert [tuple(r) for r in found] == [("a", 1, 1), ("b", 2, 2)]


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(7)

    def intervals(n):
        out = []
        for i in range(n):
            lo = rng.choice([rng.uniform(-500, 500), rng.randint(-64, 64), 0.0])
            out.append((i, float(lo), float(lo + rng.choice([0, 0.25, 1, 16, 700, 3e6]))))
        return out

    a, b = intervals(120), intervals(90)
    bands = spark.createDataFrame(a, "band int, lo double, hi double")
    posts = spark.createDataFrame(b, "post int, post_lo double, post_hi double")
    wanted = sorted(
        (i, j, min(hi, phi) - max(lo, plo))
        for i, lo, hi in a for j, plo, phi in b if lo <= phi and hi >= plo
    )
    found = overlap_join(bands, posts).select("band", "post", "overlap")
    assert sorted(tuple(r) for r in found.collect()) == wanted


def test_open_and_very_wide_ranges(spark):
    inf, big = float("inf"), 1.7e308
    a = [(0, 1.0, 2.0), (1, -5.0, inf), (2, -inf, inf), (3, 1e21, 2e21), (4, -big, big), (5, 7.0, 7.0),
         (6, 3.0, 1.0), (7, None, 1.0), (8, float("nan"), float("nan")), (9, -inf, -inf), (10, 0.1, 1e300)]
    b = [(0, 2.0, inf), (1, -inf, 1.0), (2, 0.0, 1e21), (3, 7.0, 7.0), (4, inf, inf), (5, -1e-300, 1e-300), (6, 1e300, big)]
    bands = spark.createDataFrame(a, "band int, lo double, hi double")
    posts = spark.createDataFrame(b, "post int, post_lo double, post_hi double")
    wanted = sorted(
        (i, j) for i, lo, hi in a if lo is not None and lo <= hi for j, plo, phi in b if lo <= phi and hi >= plo
    )
    found = overlap_join(bands, posts)
    assert sorted((r.band, r.post) for r in found.collect()) == wanted
    narrow = overlap_join(bands.where("band = 0"), posts.where("post = 0")).first()
    assert narrow.overlap == 0.0
    assert overlap_join(bands.where("band = 99"), posts).count() == 0


def test_overlap_of_given_ranges_is_narrow(frame):
    bands = frame([("A", 1, 10.0, 20.0), ("A", 2, 30.0, 40.0), ("A", 3, None, None)],
                  "state string, band int, lo double, hi double")
    found = overlap_ranges(bands, [("p", 20.0, 32.0), ("q", 50.0, 60.0)])
    assert sorted((r.band, r.post, r.overlap) for r in found.collect()) == [
        (1, "p", 0.0), (2, "p", 2.0)]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_ticks(frame):
    bands = frame([(1, -5.0, 20000.0), (2, 20001.0, 39999.0), (3, 175000.0, 9e6), (4, None, None)],
                  "band int, lo double, hi double")
    found = covered_ticks(bands)
    assert sorted((r.band, r.tick, r.label) for r in found.collect()) == [
        (1, 0, "$0"), (1, 20000, "$20,000"), (3, 180000, "$180,000")]

"""Block-wise results equal plain windows, whatever the block size."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rategrid.functions.blocks import number_rows, place


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for doc, n in [(1, 400), (2, 1), (3, 37)]:
        for i in rng.sample(range(n * 3), n):
            out.append((doc, i - 20, rng.choice([None, f"h{i}"]), rng.randint(0, 9)))
    return spark.createDataFrame(out, "doc int, line_no bigint, head string, n int").cache()


@pytest.mark.parametrize("block_rows", [1, 7, 100000])
@pytest.mark.parametrize("shuffle_first", [False, True])
def test_place(spark, rows, block_rows, shuffle_first):
    w = Window.partitionBy("doc").orderBy("line_no")
    wanted = rows.select(
        "doc", "line_no",
        F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"),
        F.last("head", ignorenulls=True).over(w).alias("h"),
        F.min("n").over(Window.partitionBy("doc")).alias("lo"),
        F.max("head").over(Window.partitionBy("doc")).alias("hi"),
        F.when(F.col("doc") != 2, F.col("doc") * 10).alias("fact"),
    )
    facts = spark.createDataFrame([(1, 10), (3, 30)], "doc int, fact int")
    found = place(
        rows, ["doc"], "line_no",
        before={"b": F.col("n").cast("bigint")}, latest={"h": F.col("head")},
        least={"lo": F.col("n")}, greatest={"hi": F.col("head")}, facts=facts,
        block_rows=block_rows, shuffle_first=shuffle_first,
    ).select(wanted.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        map(tuple, wanted.collect()), key=repr)


def test_number_rows(rows):
    found = number_rows(rows, ["doc"], "line_no", "k", block_rows=16)
    w = Window.partitionBy("doc").orderBy("line_no")
    wrong = found.withColumn("w", F.row_number().over(w)).where("k <> w")
    assert found.count() == rows.count() and wrong.count() == 0


def test_large_group_is_split(rows):
    """Windows run inside a block, or over block rows; never over a document's rows."""
    numbered = number_rows(rows, ["doc"], "line_no", "k")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]\n", plan)
    assert len(windows) == 2
    assert all("__block" in partition or "__block" in order for partition, order in windows)

"""Bounded samples by hash, and tables written between steps."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from rategrid.llm.sample import smallest
from rategrid.llm.store import release, stash


def test_smallest(spark):
    rows = spark.range(3000).withColumn("order", F.xxhash64("id"))
    wanted = [r["id"] for r in rows.orderBy("order", "id").limit(20).collect()]
    assert [r["id"] for r in smallest(rows, "order", 20, "id").collect()] == wanted
    same = spark.range(500).withColumn("order", F.lit(7).cast("bigint"))
    assert [r["id"] for r in smallest(same, "order", 5, "id").collect()] == [0, 1, 2, 3, 4]
    assert smallest(rows.limit(0), "order", 5, "id").count() == 0


def test_stash(spark):
    kept = stash(spark.range(5).withColumn("n", F.lit(None).cast("string")), "test")
    assert kept.count() == 5 and kept.columns == ["id", "n"]
    path = Path(kept._stash_path.removeprefix("file://"))
    assert path.exists()
    release(kept)
    assert not path.exists()

"""Ordinals of the levels of an ordered variable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Split points, at least.
SPLITS = 256


def _key(collation: str | None) -> Column:
    """What levels are ordered by; levels that a collation holds equal go by their bytes."""
    if collation is None:
        return F.col("level")
    return F.struct(F.collate("level", collation).alias("by"), F.col("level").alias("level"))


def with_ordinals(levels: DataFrame, splits: int | None = None, collation: str | None = None) -> DataFrame:
    """Add ``ordinal`` 1, 2, 3, ... to levels (level, n), each level once.

    Texts are ordered by bytes, or by the rules of a ``collation``, such as ``UNICODE`` or
    ``de``: there ``a`` comes before ``Z``.

    Levels are cut into ranges at up to ``splits`` levels picked by hash, numbered
    within their range, and moved up by the number of levels in lower ranges. So
    no task sorts all levels, however many there are. By default there are four times
    as many split points as shuffle partitions, which are set to suit the data; so
    ranges grow in number with it, and a range that happens to be wide is a small part.

    All passes read the same two columns, which lets Spark reuse one shuffle of
    the counted levels for them.
    """
    if splits is None:
        splits = max(SPLITS, 4 * int(levels.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    some = F.struct("level", "n")
    picked = (
        levels.groupBy(F.pmod(F.xxhash64("level"), F.lit(splits)).alias("slot"))
        .agg(F.min_by(some, F.xxhash64(F.lit("split"), F.col("level"))).alias("split"))
        .select("split.level").agg(F.collect_list(_key(collation)))
    )
    key = _key(collation)
    placed = levels.withColumn("splits", picked.scalar()).select(
        "level", "n", F.size(F.filter("splits", lambda s: s <= key)).alias("range")
    )
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    present = F.count(F.when(F.col("n") > 0, 1))
    moved = placed.groupBy("range").agg(present.alias("levels")).select(
        "range", F.coalesce(F.sum("levels").over(lower), F.lit(0)).alias("below")
    )
    inside = Window.partitionBy("range").orderBy(key)
    return (
        placed.join(moved, "range")
        .withColumn("ordinal", (F.col("below") + F.row_number().over(inside)).cast("int"))
        .select("level", "ordinal", "n")
    )

"""Keep going when single rows fail.

Operators that check rows give one frame, in which ``reason`` says why a row failed
and is NULL for one that worked. It is split only where good rows and rejects part,
at a sink or a join, so a query that wants both reads its input once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_reason(df: DataFrame, failed: Column, reason: Column) -> DataFrame:
    """Add ``reason`` to rows that failed; unknown counts as not failed."""
    return df.withColumn("reason", F.when(F.coalesce(failed, F.lit(False)), reason))


def worked(df: DataFrame) -> DataFrame:
    return df.where(F.col("reason").isNull()).drop("reason")


def rejects(df: DataFrame, stage: str, key: Column) -> DataFrame:
    """(stage, key, reason) of the rows that failed."""
    return df.where(F.col("reason").isNotNull()).select(
        F.lit(stage).alias("stage"), key.cast("string").alias("key"), "reason"
    )

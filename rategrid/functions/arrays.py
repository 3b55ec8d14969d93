"""One row per element of an array that was costly to make.

``explode`` and ``inline`` make Spark filter out empty arrays first, and that
filter works the array out a second time. The outer forms do not; the row they
give for an empty array is dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(
    df: DataFrame, keep: Sequence[str], array: str | Column, position: str, value: str
) -> DataFrame:
    """``position`` (from 0) and ``value`` of every element."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return rows.where(F.col(position).isNotNull())


def inlined(df: DataFrame, keep: Sequence[str], array: str | Column, never_null: str) -> DataFrame:
    """The fields of every struct; ``never_null`` names one that always has a value."""
    rows = df.select(*keep, F.inline_outer(array))
    return rows.where(F.col(never_null).isNotNull())

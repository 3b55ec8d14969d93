"""Joining sources with layouts and putting tables of several states together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_layouts(sources: DataFrame, layouts: DataFrame, key: str = "state") -> DataFrame:
    """Sources with their layout, NULL where there is none. Keys match case-sensitively.

    No broadcast is forced: a literal layout table has exact size statistics, so
    Spark broadcasts it under its own threshold and merges beyond it.
    """
    return sources.join(layouts, key, "left")


def combine_states(tables: dict[str, DataFrame], key: str = "state") -> DataFrame:
    """Tables of different columns under one key; missing columns are NULL."""
    tagged = [table.withColumn(key, F.lit(name)) for name, table in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)

"""Bounded samples by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows let through to the final ordering, for each row asked for.
SPARE = 8


def smallest(rows: DataFrame, order: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows with the smallest values of ``order``, a 64-bit hash.

    On a large table only rows below a threshold, about ``SPARE`` times as many as
    asked for, take part in the ordering; should they be too few, all do.
    """
    total = rows.count()
    if total > 2 * SPARE * n:
        below = int(-(1 << 63) + (1 << 64) * (SPARE * n / total))
        part = rows.filter(F.col(order) < F.lit(below))
        if part.count() >= n:
            rows = part
    return rows.orderBy(order, *ties).limit(n)

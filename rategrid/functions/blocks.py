"""Ordered and group-wide work over groups of any size.

Numbering lines, carrying a heading down or comparing a row with its document's
header are window functions over a document. One document may hold a large share
of all rows, and a window puts a whole group into one task. Here a group is cut
into blocks of its integer order column. A first pass reduces each block to one
small row; these rows are summed up over the group and joined back on
(keys, block). No task then holds more than one block of rows, and the rows
themselves are shuffled once.

The keys are held together in one struct. A struct is never NULL and equals another
with the same NULLs, so rows without a key are a group like any other, and joins on
it stay plain equalities that keep the partitioning.

The order column must be integral. Blocks are even when it counts up without
large holes, as line and page numbers do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

BLOCK = "__block"
KEY = "__key"
BLOCK_ROWS = 16384


def with_block(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    block_rows: int = BLOCK_ROWS,
    shuffle: bool = False,
) -> DataFrame:
    """Add the key struct and the block number, with ``shuffle`` after shuffling by both.

    The block is worked out above the shuffle, from the order column, and is never
    NULL: so passes that use the same columns have the same plan up to the shuffle,
    and Spark runs it once.
    """
    block = F.coalesce(F.floor(F.col(order) / F.lit(block_rows)), F.lit(0)).cast("bigint")
    if shuffle:
        df = df.repartition(F.struct(*keys), block)
    return df.withColumns({KEY: F.struct(*keys), BLOCK: block})


def inside_block(order: str, *ties: str) -> WindowSpec:
    return Window.partitionBy(KEY, BLOCK).orderBy(order, *ties)


def across_blocks() -> WindowSpec:
    """Over the block rows of a group, one per block."""
    return Window.partitionBy(KEY).orderBy(BLOCK)


def earlier(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _or_zero(*sums: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return sum((F.coalesce(s, zero) for s in sums[1:]), F.coalesce(sums[0], zero))


def place(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    before: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    least: Mapping[str, Column] | None = None,
    greatest: Mapping[str, Column] | None = None,
    facts: DataFrame | None = None,
    derived: Mapping[str, Column] | None = None,
    ties: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    shuffle_first: bool = False,
) -> DataFrame:
    """Add columns that a row takes from the rest of its group.

    ``before``    sum of the value over the earlier rows of the group
    ``latest``    last non-NULL value at or before the row
    ``least``     smallest value in the group
    ``greatest``  largest value in the group
    ``facts``     columns of a table with one row per key; NULL without one
    ``derived``   columns of the row itself, worked out once, in this order, for
                  use in the values above and in the result

    All columns asked for share two passes over ``df``. By default the first pass
    reads only what the values need and reduces it before its shuffle. With
    ``shuffle_first`` the rows are shuffled by (keys, block) before any value is
    worked out; when both passes need the same columns Spark runs that shuffle, and
    all that is below it, once. That is the better way when the values come from
    the wide column of the rows (a line, a page) or ``df`` is costly.

    A ``df`` that already has blocks (``with_block``) keeps them.

    Keys may be NULL, in ``facts`` as well; the order column must not. It must be
    unique in its group for ``before`` and ``latest``; for ``before`` the columns ``ties`` may
    tell rows of the same order apart.
    """
    before, latest = dict(before or {}), dict(latest or {})
    least, greatest = dict(least or {}), dict(greatest or {})
    keys = list(keys)
    values = {**before, **latest, **least, **greatest}
    inner = {name: f"__{name}" for name in values}
    rows = df if BLOCK in df.columns else with_block(df, keys, order, block_rows, shuffle_first)
    for name, value in (derived or {}).items():
        rows = rows.withColumn(name, value)
    for name, value in values.items():
        rows = rows.withColumn(inner[name], value)

    reduced = [F.sum(inner[n]).alias(n) for n in before]
    reduced += [
        F.max_by(inner[n], F.when(F.col(inner[n]).isNotNull(), F.col(order))).alias(n)
        for n in latest
    ]
    reduced += [F.min(inner[n]).alias(n) for n in least]
    reduced += [F.max(inner[n]).alias(n) for n in greatest]
    grouped = rows.groupBy(KEY, BLOCK)
    blocks = grouped.agg(*reduced) if reduced else rows.select(KEY, BLOCK).distinct()
    across = across_blocks()
    blocks = blocks.select(
        KEY,
        BLOCK,
        *[F.sum(n).over(earlier(across)).alias(n) for n in before],
        *[F.last(n, ignorenulls=True).over(earlier(across)).alias(n) for n in latest],
        *[F.min(n).over(whole(across)).alias(n) for n in least],
        *[F.max(n).over(whole(across)).alias(n) for n in greatest],
    )
    if facts is not None:
        held = [c for c in facts.columns if c not in keys]
        blocks = blocks.join(facts.select(F.struct(*keys).alias(KEY), *held), KEY, "left")

    # Sums inside the block are worked out below the join, which keeps the order they need:
    # so the rows are sorted once.
    inside = inside_block(order, *ties)
    placed = rows.drop(*[inner[n] for n in [*least, *greatest]])
    for n in before:
        placed = placed.withColumn(inner[n], F.sum(inner[n]).over(earlier(inside)))
    for n in latest:
        placed = placed.withColumn(inner[n], F.last(inner[n], ignorenulls=True).over(so_far(inside)))
    placed = placed.join(blocks, [KEY, BLOCK])
    for n in before:
        placed = placed.withColumn(n, _or_zero(F.col(n), F.col(inner[n])))
    for n in latest:
        placed = placed.withColumn(n, F.coalesce(inner[n], n))
    return placed.drop(KEY, BLOCK, *[inner[n] for n in [*before, *latest]])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str, out: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``out``: 1, 2, 3, ... within the group."""
    one = F.lit(1).cast("bigint")
    numbered = place(df, keys, order, before={out: one}, block_rows=block_rows)
    return numbered.withColumn(out, F.col(out) + 1)

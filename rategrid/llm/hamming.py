"""Links between 64-bit fingerprints that differ in few bits.

A fingerprint is indexed under several keys so that two fingerprints within the
distance share a key. All fingerprints of a key meet in one cell, where a breadth
first search finds a spanning forest of the links: linked fingerprints leave the
list of those still to be compared, so a dense cell costs about its size times the
number of its clusters, and gives one link fewer than it has members. A key with
more than ``cell`` fingerprints is cut into blocks by hash; every pair of blocks is
a cell of its own, so each pair still meets and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = 16384
#: Cells up to this size are searched one by one only if they hold a near pair.
SMALL = 64


def forest(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (position, position) that span the groups within ``most`` bits of each other."""
    left = np.arange(len(prints))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= most
            if near.any():
                new = left[near]
                found.append((new, np.full(len(new), at)))
                queue.extend(new.tolist())
                left = left[~near]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def holding(prints: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """Which of the cells that begin at ``at`` hold two fingerprints within ``most`` bits; larger ones may."""
    size = np.diff(at)
    found = size > SMALL
    owner, stop = np.repeat(np.arange(len(size)), size), np.repeat(at[1:], size)
    rows, step = np.flatnonzero(~found[owner]), 1
    while len(rows):
        rows = rows[(rows + step < stop[rows]) & ~found[owner[rows]]]
        near = np.bitwise_count(prints[rows] ^ prints[rows + step]) <= most
        found[owner[rows[near]]] = True
        step += 1
    return found


def runs(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.RecordBatch]:
    """Batches cut anew so that rows alike in their first ``by`` columns stay together."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = np.zeros(batch.num_rows, bool)
        for i in range(by):
            column = batch.column(i).to_numpy(zero_copy_only=False)
            last |= column != column[-1]
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        same = kept and all(kept[-1].column(i)[-1] == batch.column(i)[0] for i in range(by))
        if kept and not same:
            yield from _joined(kept)
            kept = []
        if cut:
            kept.append(batch.slice(0, cut))
            yield from _joined(kept)
            kept = []
        kept.append(batch.slice(cut))
    yield from _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if batches:
        yield from pa.Table.from_batches(batches).combine_chunks().to_batches()


def edges_of(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal rows, and the end of the last."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), len(new))


def spread(
    rows: DataFrame, keys: DataFrame, ident: str, cell: int = CELL
) -> DataFrame:
    """Add ``cell`` to rows with a ``key``: 0, or the pairs of blocks a row of a hot key is in.

    ``keys`` (key, n) names hot keys and a bound on their rows; it has at most
    rows / cell entries.
    """
    hot = keys.select("key", F.ceil(F.col("n") / F.lit(cell)).cast("int").alias("s"))
    own = F.pmod(F.xxhash64(ident), F.col("s")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("s") - 1),
        lambda j: F.least(own, j) * F.col("s") + F.greatest(own, j),
    )
    cells = F.when(F.col("s") > 1, pairs).otherwise(F.array(F.lit(0)))
    return rows.join(hot, "key", "left").withColumn("cell", F.explode(cells)).drop("s")


def links(
    prints: DataFrame, most: int, keys: Callable[[Column], Column],
    hot: Callable[[DataFrame, int], DataFrame], cell: int = CELL,
) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints within ``most`` bits.

    ``prints``  one column ``fp`` (bigint), distinct, written
    ``keys``    array of index keys of a fingerprint
    ``hot``     keys (key, n) that may hold more than a number of fingerprints
    """
    indexed = prints.select("fp", F.explode(keys(F.col("fp"))).alias("key"))
    crowded = hot(prints, cell)
    if crowded.limit(1).count():
        indexed = spread(indexed, crowded, "fp", cell)
    else:
        indexed = indexed.withColumn("cell", F.lit(0))
    schema = "a bigint, b bigint"

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 2):
            key, part, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            at = edges_of(key, part)
            size = np.diff(at)
            bits = fp.view(np.uint64)
            out: list[tuple[np.ndarray, np.ndarray]] = []
            some = holding(bits, at, most)
            two = at[:-1][some & (size == 2)]
            out.append((fp[two + 1], fp[two]))
            for i in np.flatnonzero(some & (size > 2)):
                one = slice(at[i], at[i + 1])
                x, y = forest(bits[one], most)
                out.append((fp[one][x], fp[one][y]))
            a, b = (np.concatenate([o[i] for o in out]) for i in (0, 1))
            if len(a):
                pairs = np.unique(np.stack([a, b], 1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
                )

    return (
        indexed.select("key", "cell", "fp")
        .repartition("key", "cell")
        .sortWithinPartitions("key", "cell", "fp")
        .mapInArrow(within, schema)
        .distinct()
    )

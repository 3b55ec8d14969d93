"""Near-duplicate vectors: all pairs within a cosine, by int8 products with error bounds.

Vectors are brought to length one and rounded to int8 with a scale each; what rounding
left over, e = |x - s q|, is known for each vector. As |x.y - s q.t r| <= e_y + e_x (1 + e_y)
(x ~ s q, y ~ t r), a product of small integers tells most pairs: those surely below the threshold
go, those surely at or above it are links, and only the rest is worked out again in
double precision. No pair is lost or made up by the rounding.

Vectors meet tile by tile. Tiles are cut so that their vectors lie in a narrow range of
angles to each of a few pivots; two tiles whose ranges to some pivot are further apart
than the threshold's angle hold no link (angles obey the triangle inequality) and don't
meet. There are at most ``TILES`` tiles of ``TILE`` vectors or, for more vectors, of more.

A pair of tiles gives each vector's number of links there and a spanning forest of the
links, so a dense group costs its products but never its pairs in rows. Vectors that are the
same are one, with a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rategrid.llm.ann import matrix, usable
from rategrid.llm.graph import components
from rategrid.llm.sample import smallest
from rategrid.llm.store import stash

COSINE = 0.95
TILE, TILES = 8192, 4096
#: Vectors that pivots are chosen from; any choice gives the same links.
SAMPLE = 1024
PIVOTS, BINS = 16, 1024
#: Rows of a tile multiplied at a time.
ROWS = 256
#: Angles and products are worked out to far less than this.
SLACK = 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Rows brought to length one."""
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit rows, their scales, and how far scale x code is from the row at most."""
    scale = np.abs(x).max(1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(1)) + 1e-12


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows, exact: a float holds sums of 1,024 products of codes."""
    if a.shape[1] <= 1024:
        return a.astype(np.float32) @ b.astype(np.float32).T
    out = np.zeros((len(a), len(b)))
    for first in range(0, a.shape[1], 1024):
        out += a[:, first:first + 1024].astype(np.float32) @ b[:, first:first + 1024].astype(np.float32).T
    return out


class Forest:
    """Links between numbered nodes, of which only those that join two trees are kept."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.kept: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            a, b = self.root[x], self.root[y]
            apart = a != b
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            high, low = np.maximum(a, b), np.minimum(a, b)
            # Every tree is hung on one of a lower number, so there are no circles.
            _, one = np.unique(high, return_index=True)
            self.kept.append((x[one], y[one]))
            self.root[high[one]] = low[one]
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.kept:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in self.kept]), np.concatenate([y for _, y in self.kept])


def near_pairs(x: np.ndarray, y: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of x, rows of y) of all pairs of unit rows with a product of ``least`` or more, block by block."""
    q, s, e = quantised(x)
    r, t, f = quantised(y)
    for first in range(0, len(x), ROWS):
        some = slice(first, first + ROWS)
        p = products(q[some], r)
        room = least - (f + e[some].max() * (1 + f)) - SLACK
        floor = np.where(room > 0, room / (s[some].max() * t), -np.inf).astype(p.dtype)
        i, j = np.nonzero(p >= np.nextafter(floor, -np.inf)[None, :])
        near = s[some][i] * t[j] * p[i, j].astype(np.float64)
        off = f[j] + e[some][i] * (1 + f[j]) + 1e-9
        sure, open_ = near - off >= least, near + off >= least
        again = np.flatnonzero(open_ & ~sure)
        for at in range(0, len(again), 1 << 16):
            k = again[at:at + (1 << 16)]
            sure[k] = (x[first + i[k]] * y[j[k]]).sum(1) >= least
        yield first + i[sure], j[sure]


def compared(table: pa.Table, least: float) -> pa.Table:
    """Link counts (x, NULL, n) and spanning links (x, y, NULL) of the vectors of a pair of tiles."""
    tile, ids, weight = (table[c].to_numpy() for c in ("tile", "id", "n"))
    a, b = table["a"][0].as_py(), table["b"][0].as_py()
    x = unit(matrix(table["v"].combine_chunks()))
    left, right = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
    counts, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
    for i, j in near_pairs(x[left], x[right], least):
        i, j = left[i], right[j]
        if a == b:
            other = i != j
            i, j = i[other], j[other]
        else:
            counts += np.bincount(j, weight[i], len(ids)).astype(np.int64)
        counts += np.bincount(i, weight[j], len(ids)).astype(np.int64)
        forest.add(i, j)
    some, (i, j) = np.flatnonzero(counts), forest.links()
    return pa.table({
        "x": pa.array(np.append(ids[some], ids[i])),
        "y": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(ids[j])]),
        "n": pa.concat_arrays([pa.array(counts[some]), pa.nulls(len(i), pa.int64())]),
    })


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` of the rows, each the farthest from those before it."""
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(n, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def dealt(counts: list[tuple[int, int, int]], tile: int) -> list[tuple[int, int, int, int]]:
    """(cell, bin, first tile, tiles) of (cell, bin, rows): neighbouring bins of a cell fill a tile, a full bin several."""
    out, number, cell_before, filled = [], -1, None, 0
    for cell, at, n in sorted(counts):
        if cell != cell_before or filled + n > tile:
            number, filled = number + 1, 0
        several = -(-n // tile)
        out.append((cell, at, number, several))
        number, filled, cell_before = number + several - 1, filled + n if several == 1 else tile, cell
    return out


def tiled(vectors: DataFrame, tile: int, tiles: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """Vectors (id, n, v, tile), written, and each tile's range of angles (tile, low, high)."""
    spark = vectors.sparkSession
    sample = smallest(vectors.withColumn("order", F.xxhash64("id", F.lit(13))), "order", SAMPLE, "id").select("v")
    centres = spark.sparkContext.broadcast(far_apart(unit(matrix(sample.toArrow()["v"].combine_chunks())), pivots))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            angle = np.arccos(np.clip(unit(matrix(batch.column(2))) @ centres.value.T, -1, 1))
            cell = angle.argmin(1)
            at = (angle[np.arange(len(angle)), cell] * (BINS / np.pi)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(cell.astype(np.int32)), pa.array(np.minimum(at, BINS - 1)),
                pa.FixedSizeListArray.from_arrays(pa.array(angle.ravel()), angle.shape[1]).cast(pa.list_(pa.float64())),
            ], names=["id", "n", "v", "cell", "bin", "angles"])

    kind = vectors.schema["v"].dataType.simpleString()
    rows = stash(
        vectors.select("id", "n", "v").mapInArrow(placed, f"id bigint, n bigint, v {kind}, cell int, bin int, angles array<double>"),
        "placed",
    )
    # At most pivots x bins rows.
    counts = [tuple(r) for r in rows.groupBy("cell", "bin").count().collect()]
    size = max(tile, -(-sum(n for _, _, n in counts) // tiles))
    deal = spark.createDataFrame(dealt(counts, size), "cell int, bin int, first int, several int")
    numbered = rows.join(F.broadcast(deal), ["cell", "bin"]).withColumn(
        "tile", F.col("first") + F.pmod(F.xxhash64("id"), F.col("several")).cast("int")
    )
    count = len(centres.value)
    ranges = numbered.groupBy("tile").agg(*[
        f(F.col("angles")[i]).alias(f"{name}{i}") for i in range(count) for name, f in (("low", F.min), ("high", F.max))
    ]).select("tile", *[F.array(*[f"{name}{i}" for i in range(count)]).alias(name) for name in ("low", "high")])
    return numbered.select("id", "n", "v", "tile"), stash(ranges, "ranges")


def meetings(ranges: DataFrame, least: float) -> DataFrame:
    """(tile, a, b): the pairs of tiles, a <= b, that may hold a link, once for each of their tiles."""
    # A row per tile: their number is bounded.
    table = ranges.toArrow()
    number, low, high = table["tile"].to_numpy(), matrix(table["low"].combine_chunks()), matrix(table["high"].combine_chunks())
    held = ranges.sparkSession.sparkContext.broadcast((number, low - SLACK, high + SLACK))
    angle = float(np.arccos(least)) + SLACK

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, low, high = held.value
        for batch in batches:
            for mine in batch.column(0).to_pylist():
                i = int(np.flatnonzero(number == mine)[0])
                apart = np.maximum(low - high[i], low[i] - high).max(1)
                other = number[apart <= angle]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32()) for c in (np.full(len(other), mine), np.minimum(other, mine), np.maximum(other, mine))],
                    names=["tile", "a", "b"],
                )

    return ranges.select("tile").mapInArrow(partners, "tile int, a int, b int")


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = COSINE,
    tile: int = TILE, tiles: int = TILES, pivots: int = PIVOTS,
) -> DataFrame:
    """One row (key, n_links, component_id, kept) per id.

    ``n_links`` counts the other vectors within the cosine, ``component_id`` is the smallest id
    reached over links, ``kept`` marks the row that has it. Vectors that are NULL, zero, hold NULL
    or non-finite numbers or differ in length from the commonest link with nothing. An id that
    repeats counts once, with its smallest usable vector; rows without an id come back as one row
    with a NULL component. An empty table gives an empty one; other columns are not read.
    """
    if not 0 < least <= 1:
        raise ValueError("the cosine must be above 0 and not above 1")
    good = stash(usable(rows, key, vector), "vectors")
    classes = stash(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "classes")
    ids = rows.select(F.col(key).cast("bigint").alias("vec_id")).distinct()
    if classes.limit(1).count():
        placed, ranges = tiled(classes, tile, tiles, pivots)
        cells = placed.join(meetings(ranges, least), "tile").groupBy("a", "b")
        found = stash(cells.applyInArrow(lambda t: compared(t, least), "x bigint, y bigint, n bigint"), "found")
        counts = found.filter(F.col("y").isNull()).groupBy("x").agg(F.sum("n").alias("more"))
        groups = components(found.filter(F.col("y").isNotNull()).select("x", "y")).toDF("id", "least")
        named = (
            classes.join(counts.withColumnRenamed("x", "id"), "id", "left").join(groups, "id", "left")
            .select("v", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("least", "id").alias("least"))
        )
        ids = ids.join(good.join(named, "v").drop("v"), "vec_id", "left")
    else:
        ids = ids.withColumns({"n_links": F.lit(0).cast("bigint"), "least": F.col("vec_id")})
    component = F.coalesce("least", "vec_id")
    return ids.select(
        F.col("vec_id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

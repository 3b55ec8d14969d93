"""Harmonic packing of token sequences.

A piece of r tokens belongs to class k = capacity // r: a sequence takes k pieces of
that class, whatever they are, so every worker can fill sequences without knowing
what the others hold. Plain harmonic packing wastes what a piece is shorter than
capacity / k. Documents may be cut, so a piece that would waste more than a small
share of its slot is cut down to the slot of the next class, and the rest, which is
shorter still, is cut by the same rule. What is left of a document of any length is
cut a few times at most.

The pieces of a class are numbered over all workers from one small table of counts
(worker, class); number // k names the sequence. The last, open sequence of each
class holds fewer than k pieces. These rests, bounded by the capacity alone and not
by the data, are put together by first fit, longest first.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rategrid.llm.store import stash
from rategrid.llm.tokens import END_BYTES, VOCABULARY, words

CAPACITY = 2048
#: Share of a slot that may stay empty before a piece is cut.
SLACK = 1 / 64
#: Pieces of at most this length are not cut.
SHORT = 32

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "k int, worker int, nth bigint"
)


def cuts(tokens: int, capacity: int = CAPACITY, slack: float = SLACK, short: int = SHORT) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        if rest <= short or rest >= (capacity // k) * (1 - slack):
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def first_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, longest first, in the first bin with room."""
    free: list[int] = []
    out = [(0, 0)] * len(lengths)
    first = 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        while first < len(free) and not free[first]:
            first += 1
        at = next((b for b in range(first, len(free)) if free[b] >= lengths[i]), len(free))
        if at == len(free):
            free.append(capacity)
        out[i] = (at, capacity - free[at])
        free[at] -= lengths[i]
    return out


def cut_documents(docs: DataFrame, key: str, text: str, path: str, capacity: int) -> DataFrame:
    """Pieces of all documents, numbered within their worker and class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, worker = words(path), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = memoryview(table.ids(body or "") + END_BYTES)
                start = 0
                for length in cuts(len(ids) // 4, capacity):
                    k = capacity // length
                    check = zlib.crc32(ids[4 * start:4 * (start + length)])
                    rows.append((doc, start, length, check, len(ids) // 4, k, worker, seen[k]))
                    seen[k] += 1
                    start += length
            if rows:
                types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=[c.split()[0] for c in PIECES.split(", ")],
                )

    return docs.select(F.col(key).cast("bigint"), text).mapInArrow(cut, PIECES)


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    path: str = VOCABULARY, capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: where it comes from, and its sequence and offset there.

    NULL and empty texts are one piece, the end id alone. A NULL key stays NULL;
    repeated rows are packed each for itself. An empty table gives an empty one.
    Other columns are not read. Sequences may be shorter than ``capacity`` and are
    to be padded to it, but for lengths that are powers of two.
    """
    pieces = stash(cut_documents(docs, key, text, path, capacity), "pieces")
    counts = pieces.groupBy("worker", "k").agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("k")
    before = of_class.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "worker", "k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(of_class).alias("all"),
    )
    # One row per class: at most 2 * sqrt(capacity) of them.
    full = counts.groupBy("k").agg(F.floor(F.max("all") / F.col("k")).alias("full"))
    earlier = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    full = full.select(
        "k", "full", F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("base"),
        F.sum("full").over(Window.partitionBy()).alias("sequences"),
    )
    counts = stash(counts.join(full, "k"), "counts")
    placed = pieces.join(counts, ["worker", "k"]).withColumn("nth", F.col("before") + F.col("nth"))
    placed = placed.withColumn("bin", F.floor(F.col("nth") / F.col("k")).cast("bigint"))
    filled = Window.partitionBy("sequence_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = (
        placed.filter("bin < full").withColumn("sequence_id", F.col("base") + F.col("bin"))
        .withColumn("offset", F.coalesce(F.sum("length").over(filled), F.lit(0)))
        .select(names)
    )
    rests = placed.filter("bin >= full").select(*names[:5], "sequences")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), schema=rest_schema).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        )
        if rows.num_rows:
            at = first_fit(rows["length"].to_pylist(), capacity)
            first = rows["sequences"][0].as_py()
            rows = rows.drop(["sequences"]).append_column(
                "sequence_id", pa.array([first + b for b, _ in at], pa.int64())
            ).append_column("offset", pa.array([o for _, o in at], pa.int64()))
            yield from rows.combine_chunks().to_batches()

    rest_schema = pa.schema([(n, pa.int64()) for n in [*names[:5], "sequences"]])
    last = rests.repartition(1).mapInArrow(fit, ", ".join(f"{n} bigint" for n in names))
    return whole.unionByName(last).select(
        F.col("doc_id").alias(key), *names[1:]
    )

"""Near-duplicate documents by SimHash, found through deletion-variant signatures.

A fingerprint has 64 bits, each set where over half of the shingle hashes have it.
Within four differing bits one of three segments differs in at most one bit. Every
segment is indexed once for each of its bits, with that bit masked out: two segments
that differ in one bit share the variant that masks it, equal segments share all. So
an equality on (masked bit, remaining bits of the segment), 64 keys a fingerprint,
meets every pair; the distance of whole fingerprints is then checked.

Equal fingerprints are one node, so copies never meet each other. Cells and hot keys
are treated in ``hamming``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rategrid.llm import hamming
from rategrid.llm.graph import components
from rategrid.llm.store import stash

SHINGLE = 4
BITS = 4
SEED = 42
#: Widths of the segments, lowest bits first.
SEGMENTS = (21, 21, 22)
_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: The eight bits of a byte as eight counters of eight bits.
_LANES = np.ascontiguousarray(_BYTE).view(np.uint64).ravel()


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set."""
    n = len(hashes)
    lanes = np.zeros((-(-n // 255) * 255, 8), np.uint64)
    lanes[:n] = _LANES[hashes.astype("<u8").view(np.uint8).reshape(n, 8)]
    sums = lanes.reshape(-1, 255, 8).sum(axis=1)
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: str, shingle: int = SHINGLE, block: int = 1 << 16) -> int:
    """SimHash of a text, unsigned; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    take = min(shingle, len(words))
    n = len(words) - take + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for first in range(0, n, block):
        part = words[first:first + block + take - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(part) - take + 1].tolist()
        stops = (ends[take - 1:] - 1).tolist()
        counts += bit_counts(np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts, stops, strict=True)], np.uint64
        ))
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """Add the fingerprint of a text column as a signed 64-bit number; NULL text counts as empty.

    A column that is called ``out`` already is replaced.
    """
    if out == text:
        raise ValueError("the fingerprint needs another column than the text")
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array(
                [fingerprint(t or "", shingle) for t in batch.column(at).to_pylist()], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints.view(np.int64))], names=schema.names
            )

    return docs.mapInArrow(add, schema)


def _masks() -> list[tuple[int, int]]:
    """(mask of the segment without a bit, its lowest bit), for each bit."""
    out, low = [], 0
    for width in SEGMENTS:
        for bit in range(width):
            out.append(((((1 << width) - 1) ^ (1 << bit)) << low, low))
        low += width
    return out


def variant_keys(fp: Column) -> Column:
    """64 index keys: the masked bit above, the rest of its segment below."""
    keys = []
    for i, (mask, low) in enumerate(_masks()):
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.shiftrightunsigned(fp.bitwiseAND(F.lit(signed)), low).bitwiseOR(F.lit(i << 22)))
    return F.array(*keys)


def crowded_variants(prints: DataFrame, cell: int) -> DataFrame:
    """Keys (key, n) that may hold over ``cell`` fingerprints.

    A key holds the fingerprints of two values of a segment. So only the values with
    more than half a cell are followed; they are at most six in a cell of rows.
    """
    low, parts = 0, []
    for s, width in enumerate(SEGMENTS):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        parts.append(F.struct(F.lit(s).alias("s"), value.alias("v")))
        low += width
    values = prints.select(F.explode(F.array(*parts)).alias("p")).groupBy("p.s", "p.v").count()
    heavy = values.filter(F.col("count") > cell // 2)
    first = np.cumsum([0, *SEGMENTS[:-1]]).tolist()
    of = F.element_at(F.array(*[F.lit(x) for x in first]), F.col("s") + 1)
    width = F.element_at(F.array(*[F.lit(x) for x in SEGMENTS]), F.col("s") + 1)
    keyed = heavy.withColumn("bit", F.explode(F.sequence(F.lit(0), width - 1)))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    key = F.col("v").bitwiseAND(F.bitwise_not(one)).bitwiseOR(
        F.call_function("shiftleft", (of + F.col("bit")).cast("bigint"), F.lit(22))
    )
    return (
        keyed.select(key.alias("key"), "count")
        .groupBy("key").agg((F.sum("count") + F.lit(cell // 2)).alias("n"))
        .filter(F.col("n") > cell)
    )


def linked(prints: DataFrame, bits: int = BITS, cell: int = hamming.CELL) -> DataFrame:
    """(fp, group): each distinct fingerprint that has a link, with its component's smallest."""
    if bits >= 2 * len(SEGMENTS):
        raise ValueError("with so many bits no segment need be within one")
    found = hamming.links(prints, bits, variant_keys, crowded_variants, cell)
    return components(found).toDF("fp", "group")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, bits: int = BITS, cell: int = hamming.CELL,
) -> DataFrame:
    """One row (key, fp, component_id) per row of ``docs``.

    ``component_id`` is the smallest key reachable over links of at most ``bits``
    bits; NULL where no row of the component has a key. NULL, empty and blank texts
    have fingerprint 0, which links like any other. Repeated rows give repeated
    rows; an empty table gives an empty one. Other columns are not read.
    """
    rows = stash(
        with_fingerprint(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), shingle=shingle)
        .select("key", "fp"),
        "prints",
    )
    named = least_of(rows, "key", bits, cell).withColumnRenamed("least", "component_id")
    return rows.join(named, "fp").select(F.col("key").alias(key), "fp", "component_id")


def least_of(rows: DataFrame, value: str, bits: int, cell: int) -> DataFrame:
    """(fp, least): the smallest value in the component of each distinct fingerprint of ``rows``."""
    prints = stash(rows.groupBy("fp").agg(F.min(value).alias("least")), "distinct")
    groups = linked(prints.select("fp"), bits, cell)
    member = prints.join(groups, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    least = member.groupBy("group").agg(F.min("least").alias("least"))
    return member.select("fp", "group").join(least, "group").select("fp", "least")


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, bits: int = BITS,
) -> DataFrame:
    """The rows of ``docs``, with one document of each near-duplicate group.

    The one with the smallest key stays; of several texts of that key in the group, that
    of the smallest hash, and of repeated rows, one. Rows without a key can't be named:
    they stay.
    """
    named = docs.filter(F.col(key).isNotNull())
    a, b = F.xxhash64(text, F.isnull(text), F.lit(1)), F.xxhash64(F.lit(2), text, F.isnull(text))
    row = F.struct(F.col(key).alias("key"), a.alias("a"), b.alias("b"))
    # Rows without a key link others, but are never the least.
    rows = stash(
        with_fingerprint(
            docs.select(F.when(F.col(key).isNotNull(), row).alias("row"), F.col(text).alias("text")), shingle=shingle
        ).select("row", "fp"),
        "prints",
    )
    # A text has one fingerprint, so a row is the least of one component at most.
    stays = least_of(rows, "row", bits, hamming.CELL).select("least").distinct()
    mark, order = "__row", "__first"
    while {mark, order} & set(docs.columns):
        mark, order = mark + "_", order + "_"
    first = Window.partitionBy(mark).orderBy(text)
    kept = (
        named.withColumn(mark, row)
        .join(stays.withColumnRenamed("least", mark), mark, "left_semi")
        .withColumn(order, F.row_number().over(first)).filter(F.col(order) == 1)
    )
    return kept.select(docs.columns).unionByName(docs.filter(F.col(key).isNull()))

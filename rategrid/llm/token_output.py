"""Token ids of documents in files of frequency-ranked, byte-aligned codes.

Ids are replaced by their rank in the corpus, the most frequent first, and a rank is
written in as few whole bytes as hold it. The lengths stand apart, four to a control
byte, so a reader finds the bytes of all codes of a block by table lookup and sums,
without a step per id.

A file holds blocks of documents in ascending key order. A block is

    magic     4 bytes ``RGT1``
    documents uint32, ids uint64
    keys      int64 each, one byte each that is 1 where the key is NULL
    counts    uint64 each, the ids of each document with the end id
    control   two bits a code: bytes of the code less one, lowest bits first
    data      the codes, lowest byte first

all little-endian. Blocks are rows (file, block, ids, payload) of a Parquet table in
the shared folder. An index (file, block, start) says how many ids stand before a
block; the code book (id, rank) is as long as the vocabulary.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rategrid.llm.store import release, stash
from rategrid.llm.tokens import END_BYTES, VOCABULARY, words

MAGIC = b"RGT1"
#: A block is closed at this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 20
#: Numbers that are coded or decoded at a time; a multiple of four.
STEP = 1 << 18
_CODES = np.arange(256, dtype=np.uint8)
#: Lengths of the four codes of a control byte.
LENGTHS = np.stack([(_CODES >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1)


def code(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    controls, datas = [], []
    for first in range(0, len(ranks), STEP):
        some = ranks[first:first + STEP].astype("<u4")
        size = 1 + (some > 0xFF) + (some > 0xFFFF) + (some > 0xFFFFFF)
        two = np.zeros(-(-len(some) // 4) * 4, np.uint8)
        two[:len(some)] = size - 1
        two = two.reshape(-1, 4)
        control = two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6
        controls.append(control.astype(np.uint8).tobytes())
        datas.append(some.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes())
    return b"".join(controls), b"".join(datas)


def decode(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The numbers again: lengths by table lookup, places by their sums."""
    out, at = np.empty(n, np.uint32), 0
    for first in range(0, n, STEP):
        some = out[first:first + STEP]
        size = LENGTHS[control[first // 4:(first + STEP) // 4]].ravel()[:len(some)]
        starts = np.cumsum(size, dtype=np.int64) - size + at
        some[:] = data[starts]
        for i in (1, 2, 3):
            longer = np.flatnonzero(size > i)
            if not len(longer):
                break
            some[longer] |= data[starts[longer] + i].astype(np.uint32) << np.uint32(8 * i)
        at += int(size.sum(dtype=np.int64))
    return out


def control_bytes(n: int) -> int:
    return -(-n // 4)


def write_block(keys: list[int | None], counts: list[int], control: bytes, data: bytes) -> bytes:
    return b"".join([
        MAGIC, struct.pack("<IQ", len(keys), sum(counts)),
        np.array([k or 0 for k in keys], "<i8").tobytes(),
        np.array([k is None for k in keys], np.uint8).tobytes(),
        np.array(counts, "<u8").tobytes(), control, data,
    ])


def read_block(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, counts and ranks of a block."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, ids = struct.unpack_from("<IQ", payload, 4)
    at = 16
    keys = np.frombuffer(payload, "<i8", n, at).tolist()
    missing = np.frombuffer(payload, np.uint8, n, at + 8 * n)
    counts = np.frombuffer(payload, "<u8", n, at + 9 * n).astype(np.int64)
    at += 17 * n
    control = np.frombuffer(payload, np.uint8, control_bytes(ids), at)
    data = np.frombuffer(payload, np.uint8, offset=at + control_bytes(ids))
    keys = [None if m else k for k, m in zip(keys, missing.tolist(), strict=True)]
    return keys, counts, decode(control, data, ids)


class Written(NamedTuple):
    """The tables that hold the files and their code book."""

    blocks: DataFrame
    index: DataFrame
    book: DataFrame


def encode_documents(docs: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(key, ids, tally): the ids of each row, and per task one row with how often each id occurs.

    Ids are little-endian, of 16 bits where the vocabulary allows it, else of 32.
    """
    size, width = _vocabulary(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = words(path), np.zeros(size, "<i8")
        names = ["key", "ids", "tally"]
        for batch in batches:
            ids = [
                np.frombuffer(table.ids(t or "") + END_BYTES, "<u4").astype(width)
                for t in batch.column(1).to_pylist()
            ]
            if ids:
                total += np.bincount(np.concatenate(ids), minlength=size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([i.tobytes() for i in ids], pa.binary()), pa.nulls(len(ids), pa.binary())],
                names=names,
            )
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], names=names
        )

    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(
        encode, "key bigint, ids binary, tally binary"
    )


def _vocabulary(path: str) -> tuple[int, str]:
    """How many ids there are, and the numpy type that holds them."""
    size = words(path).tokenizer.get_vocab_size()
    return size, "<u2" if size <= 1 << 16 else "<u4"


def tallied(encoded: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for tally in batch.column(0).to_pylist():
                total += np.frombuffer(tally, "<i8")
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    counts = (
        encoded.select("tally").filter(F.col("tally").isNotNull())
        .mapInArrow(add, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    )
    total = np.zeros(size, np.int64)
    # At most one row for each id of the vocabulary.
    for r in counts.collect():
        total[r["id"]] = r["n"]
    return total


def _kept(rows: DataFrame, folder: str | None, name: str) -> DataFrame:
    """A table written below a folder that stays, or for the time of the application."""
    if folder is None:
        return stash(rows, name)
    rows.write.parquet(f"{folder.rstrip('/')}/{name}")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder.rstrip('/')}/{name}")


def load(spark: SparkSession, folder: str) -> Written:
    """What ``write`` has left in a folder, for ``read`` in any session."""
    return Written(*(spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in ("blocks", "index", "book")))


def write(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, folder: str | None = None
) -> Written:
    """Write the ids of all documents, an end id after each, in ascending key order.

    With ``folder``, a new one, the files stay there: ``blocks`` (a file of blocks per range
    of keys), ``index`` (the ids before each block) and ``book`` (the id of each rank).
    Without, they go when the application ends.

    NULL texts are empty; NULL keys come first; rows of one key are ordered by their
    ids, so repeated rows stand side by side. An empty table gives no blocks. Other
    columns are not read.
    """
    size, width = _vocabulary(path)
    encoded = stash(encode_documents(docs, key, text, path), "ids")
    total = tallied(encoded, size)
    found = np.lexsort((np.arange(size), -total))[:int((total > 0).sum())]
    rank_of = np.zeros(size, np.uint32)
    rank_of[found] = np.arange(len(found))
    book = docs.sparkSession.createDataFrame(
        [(int(t), i) for i, t in enumerate(found)], "id bigint, rank bigint"
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block = TaskContext.get().partitionId(), 0
        keys, held = [], []

        def close() -> pa.RecordBatch:
            control, data = code(rank_of[np.concatenate(held)])
            payload = write_block(keys, [len(h) for h in held], control, data)
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([sum(map(len, held))], pa.int64()), pa.array([payload], pa.binary())],
                names=["file", "block", "ids", "payload"],
            )

        n = 0
        for batch in batches:
            for k, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                ids = np.frombuffer(ids, width)
                if keys and n + len(ids) > BLOCK_IDS:
                    yield close()
                    block, keys, held, n = block + 1, [], [], 0
                keys.append(k)
                held.append(ids)
                n += len(ids)
        if keys:
            yield close()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        encoded.filter(F.col("ids").isNotNull()).select("key", "ids")
        .repartitionByRange(parts, "key")
        .sortWithinPartitions("key", "ids")
        .mapInArrow(blocks, "file int, block int, ids bigint, payload binary")
    )
    written = _kept(rows, folder, "blocks")
    release(encoded)
    index = index_of(written)
    if folder is not None:
        index, book = _kept(index, folder, "index"), _kept(book, folder, "book")
    return Written(written, index, book)


def index_of(blocks: DataFrame) -> DataFrame:
    """(file, block, start), the ids before each block: sums per file, then over the files."""
    sizes = blocks.select("file", "block", "ids")
    files = sizes.groupBy("file").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(files, "file").select(
        "file", "block", (F.col("first") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).alias("start")
    )


def read_documents(written: Written) -> DataFrame:
    """(file, block, key, inside, n_tokens, ids): the documents of each block as they stand there."""
    book = {r["rank"]: r["id"] for r in written.book.collect()}
    id_of = np.array([book[i] for i in range(len(book))], "<u4")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, counts, ranks = read_block(payload)
                ends = np.cumsum(counts)
                ids = np.split(id_of[ranks], ends[:-1])
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(keys, pa.int64()),
                     pa.array(ends - counts), pa.array(counts), pa.array([i.tobytes() for i in ids], pa.binary())],
                    names=["file", "block", "key", "inside", "n_tokens", "ids"],
                )

    found = written.blocks.select("file", "block", "payload").mapInArrow(
        documents, "file int, block int, key bigint, inside bigint, n_tokens bigint, ids binary"
    )
    return found


def read(written: Written, key: str = "doc_id", checks: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids): the documents of the files, ids as little-endian 32-bit numbers.

    With ``checks`` the CRC-32 of the ids, ``ids_crc32``, stands in place of the ids and
    only that is joined with the index.
    """
    found, last = read_documents(written), "ids"
    if checks:
        found, last = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "ids_crc32"
    return found.join(written.index, ["file", "block"]).select(
        F.col("key").alias(key), (F.col("start") + F.col("inside")).alias("start"), "n_tokens", last
    )

"""Byte-pair encoding and decoding through a table of distinct words.

Documents are taken in blocks, as they are read. A block lists its distinct words,
and each document of it as places in that list. Only the lists are shuffled: by word,
where a word that many blocks have is encoded once, and its ids go back by (block,
place). A common word has one row per block, so no key is hot.

For decoding, the ids that a block uses, at most as many as the vocabulary has, are
joined with the table (id, piece); documents are then written out from the pieces.

A block is built twice, once for its words and once for its documents, from the same
scan. That costs a second reading of the text and saves a copy on disk. Its number is
a hash of all that is in it, so the two meet only if they are the same; blocks of the
same rows in the same order share their number and their words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rategrid.llm.hamming import edges_of
from rategrid.llm.store import steady
from rategrid.llm.token_output import code, control_bytes, decode
from rategrid.llm.tokens import VOCABULARY, words

#: A block is closed at this many words, or distinct words; a longer document is a block of its own.
BLOCK_WORDS = 1 << 22
BLOCK_DISTINCT = 1 << 19


class _Block:
    def __init__(self) -> None:
        self.place: defaultdict[bytes, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.keys: list[int | None] = []
        self.counts: list[int] = []
        self.parts: list[np.ndarray] = []

    def add(self, key: int | None, found: list[bytes]) -> None:
        self.keys.append(key)
        self.counts.append(len(found))
        self.parts.append(np.fromiter(map(self.place.__getitem__, found), np.uint32, len(found)))

    def listed(self) -> tuple[list[bytes], np.ndarray]:
        """Distinct words, the most frequent first, and the places of all words."""
        at = np.concatenate(self.parts) if self.parts else np.empty(0, np.uint32)
        order = np.argsort(-np.bincount(at, minlength=len(self.place)), kind="stable")
        new = np.empty(len(order), np.uint32)
        new[order] = np.arange(len(order))
        found = list(self.place)
        listed = [found[i] for i in order.tolist()]
        return listed, new[at]

    def number(self, listed: list[bytes], at: np.ndarray) -> int:
        digest = xxhash.xxh3_64(repr((self.keys, self.counts)))
        digest.update(b"\n".join(listed))
        digest.update(at)
        return int.from_bytes(digest.digest(), "little", signed=True)


def blocks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[_Block]:
    """Blocks of (key, text) batches."""
    split, block, n = words(path).split, _Block(), 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = split(text or "")
            if block.keys and (n + len(found) > BLOCK_WORDS or len(block.place) > BLOCK_DISTINCT):
                yield block
                block, n = _Block(), 0
            block.add(key, found)
            n += len(found)
    if block.keys:
        yield block


#: Kinds of rows that meet in a block.
WORDS, DOCUMENTS = b"W", b"D"
#: Encoded words that are dealt to their blocks together: a row per block, not per word.
TOGETHER = 200_000
FEW = 20_000
#: Documents that are written out together, in words.
WRITTEN = 1 << 18


def pack_words(places: np.ndarray, ids: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
    body = np.uint32(len(ids)).tobytes() + places.astype("<u4").tobytes() + sizes.tobytes() + b"".join(ids)
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack_words(packed: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Places, where the ids of each end, and all ids."""
    body = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(body, "<u4", 1)[0])
    sizes = np.frombuffer(body, "<u4", n, 4 + 4 * n)
    return np.frombuffer(body, "<u4", n, 4), np.cumsum(sizes, dtype=np.int64), body[4 + 8 * n:]


def pack_documents(keys: list[int | None], counts: list[int], places: np.ndarray) -> bytes:
    control, data = code(places)
    body = b"".join([
        np.uint32(len(keys)).tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(),
        np.array([k is None for k in keys], np.uint8).tobytes(), np.array(counts, "<u4").tobytes(), control, data,
    ])
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpack_documents(packed: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(body, "<u4", 1)[0])
    keys = np.frombuffer(body, "<i8", n, 4).tolist()
    missing = np.frombuffer(body, np.uint8, n, 4 + 8 * n).tolist()
    counts = np.frombuffer(body, "<u4", n, 4 + 9 * n).astype(np.int64)
    coded = np.frombuffer(body, np.uint8, offset=4 + 13 * n)
    total = int(counts.sum())
    places = decode(coded[:control_bytes(total)], coded[control_bytes(total):], total)
    return [None if m else k for k, m in zip(keys, missing, strict=True)], counts.tolist(), places


def _gathered(numbers: list[int], bodies: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int64()), pa.array(bodies, pa.binary())], names=["block", "body"]
    )


def pieces(spark, path: str = VOCABULARY) -> DataFrame:
    """(id, piece) of a vocabulary."""
    held = words(path).tokenizer.get_vocab(with_added_tokens=True)
    return spark.createDataFrame(
        pa.table({"id": pa.array(held.values(), pa.int32()), "piece": pa.array(held.keys(), pa.string())})
    )


def encode_and_decode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """(key, ids, decoded) per row: little-endian 32-bit ids, and the text they stand for.

    NULL texts are empty and give no ids and an empty text. NULL keys stay NULL,
    repeated rows give repeated rows, an empty table an empty one. Other columns are
    not read. Rows whose order may change between readings, as after a shuffle, are
    written first.
    """
    # Words and documents of a block are told from two readings, which must agree.
    given = steady(docs.select(F.col(key).cast("bigint"), F.col(text)), "texts")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, path):
            listed, at = block.listed()
            number = block.number(listed, at)
            # In order of the words, so that neighbours in a shuffle file look alike.
            order = sorted(range(len(listed)), key=listed.__getitem__)
            for first in range(0, len(order), 1 << 16):
                part = order[first:first + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(part), pa.int64()), pa.array(part, pa.int32()),
                     pa.array([listed[i] for i in part], pa.binary())],
                    names=["block", "place", "word"],
                )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, path):
            listed, at = block.listed()
            yield _gathered([block.number(listed, at)], [DOCUMENTS + pack_documents(block.keys, block.counts, at)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Words come in order, so a small table is enough to look each up in the library once.
        table = words(path, FEW)
        blocks_of, places, ids = [], [], []

        def packed() -> pa.RecordBatch:
            number, place = np.concatenate(blocks_of), np.concatenate(places)
            order = np.argsort(number, kind="stable")
            cut = edges_of(number[order])
            numbers, bodies = [], []
            for first, last in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                some = order[first:last]
                numbers.append(int(number[some[0]]))
                bodies.append(WORDS + pack_words(place[some], [ids[i] for i in some.tolist()]))
            return _gathered(numbers, bodies)

        for batch in batches:
            if batch.num_rows:
                blocks_of.append(batch.column(0).to_numpy())
                places.append(batch.column(1).to_numpy())
                ids += [table[w] for w in batch.column(2).to_pylist()]
            if len(ids) >= TOGETHER:
                yield packed()
                blocks_of, places, ids = [], [], []
        if ids:
            yield packed()

    rows = "block bigint, body binary"
    encoded = (
        given.mapInArrow(lists, "block bigint, place int, word binary")
        .repartition("word").sortWithinPartitions("word")
        .mapInArrow(encode, rows)
    )
    # Both uses below read the same shuffle.
    gathered = encoded.unionByName(given.mapInArrow(documents, rows)).repartition("block")

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: defaultdict[int, set[int]] = defaultdict(set)
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if body[:1] == WORDS:
                    _, _, ids = unpack_words(body[1:])
                    by[number].update(np.unique(np.frombuffer(ids, "<u4")).tolist())
            for number, found in by.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(found), pa.int64()), pa.array(sorted(found), pa.int32())], names=["block", "id"]
                )

    # A row for each id of a block at most; the vocabulary has a fixed length.
    named = gathered.mapInArrow(used, "block bigint, id int").distinct().join(
        F.broadcast(pieces(docs.sparkSession, path)), "id"
    )

    def write(left: pa.Table, right: pa.Table) -> pa.Table:
        piece = dict(zip(right["id"].to_pylist(), right["piece"].to_pylist(), strict=True))
        bodies = left["body"].to_pylist()
        found = [unpack_words(b[1:]) for b in bodies if b[:1] == WORDS]
        own = [b[1:] for b in bodies if b[:1] == DOCUMENTS]
        size = max((int(p.max()) + 1 for p, _, _ in found), default=0)
        word_ids: list[bytes | None] = [None] * size
        for place, ends, ids in found:
            start = 0
            for p, end in zip(place.tolist(), ends.tolist(), strict=True):
                word_ids[p] = ids[start:end]
                start = end
        if not own or None in word_ids:
            raise RuntimeError("the words and the documents of a block come from different readings")
        shown = [" ".join([piece[x] for x in memoryview(i).cast("I")]) for i in word_ids]
        blank = not all(shown)
        tables = []
        for body in own:
            keys, counts, places = unpack_documents(body)
            ends = np.cumsum(counts)
            first, start = 0, 0
            while first < len(keys):
                last = max(first + 1, int(np.searchsorted(ends, start + WRITTEN, "right")))
                out_ids, out_text = [], []
                for c in counts[first:last]:
                    mine = places[start:start + c].tolist()
                    start += c
                    out_ids.append(b"".join([word_ids[i] for i in mine]))
                    seen = [shown[i] for i in mine]
                    out_text.append(" ".join([s for s in seen if s] if blank else seen))
                tables.append(pa.table({
                    "key": pa.array(keys[first:last], pa.int64()),
                    "ids": pa.array(out_ids, pa.binary()), "decoded": pa.array(out_text, pa.string()),
                }))
                first = last
        return pa.concat_tables(tables)

    done = gathered.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(
        write, "key bigint, ids binary, decoded string"
    )
    return done.withColumnRenamed("key", key)

"""Phrases whose words stand together more often than chance, by language.

A phrase must occur ``least`` times. Which ones do is found without counting all n-grams:

* The occurrences are dealt by the hash of (language, words) to hash partitions. Each
  has a Misra-Gries summary with more counters than its occurrences (its mass) divided by
  ``least``: what occurs that often is sure to keep a counter. Every task tallies its own
  texts; tallies are summaries too, and merge by adding counters and, where there are too
  many, taking off the value of the first that finds no room. The sum of what was taken
  off bounds how far a counter falls short, so counters that can't reach ``least`` go.
* Words and pairs are summarised first. Longer phrases are then dealt only where all their
  pairs survive: a phrase is no more frequent than its pairs.
* The last pass counts the survivors, by their words, exactly. A task adds its counts up
  and deals them by hash partition, a row for each; a partition's rows are added up in turn.

A partition's summary is bounded by its capacity, and there are more partitions where
there is more text. A very common phrase is one row of a tally. Survivors go to all
tasks while there are at most ``HELD``; beyond that nothing is left out early, and the
last pass meets them in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rategrid.llm.store import release, stash

LEAST, LONGEST, TOP = 100, 5, 2000
#: Language of texts that have none.
UNKNOWN = "und"
#: Bytes of text worked on at a time, occurrences tallied together, and words whose hash is kept.
CHUNK, TALLY, KNOWN = 1 << 21, 1 << 21, 300_000
#: Hash partitions at least, so that a tally's share of one is small; counters of a summary, about.
PARTS, COUNTERS = 4096, 1 << 18
#: Bytes of exact counts that are held before they are added up.
SUMMED = 1 << 25
#: Survivors, and totals of languages, that are sent to every task, at most.
HELD, LANGUAGES = 1 << 21, 100_000
#: Marks and line ends end a piece, blanks and tabs a word.
_FLAT = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


class _Words(dict[bytes, int]):
    """Hashes of the words a task has met; at most ``KNOWN`` are kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class Chunk:
    """The words of some texts, in order, with their piece and language, and the hashes of n-grams."""

    def __init__(self, texts: list[bytes], langs: np.ndarray, seeds: np.ndarray, hashes: _Words) -> None:
        data = b"\n".join(texts).lower().translate(_FLAT)
        self.words = data.split()
        held = np.frombuffer(data, np.uint8)
        end = held == 0x0A
        inside = ~(end | (held == 0x20))
        first = np.flatnonzero(inside & np.append(True, ~inside[:-1])[:len(inside)])
        self.piece = np.cumsum(end, dtype=np.int32)[first]
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), first, "right")
        self.lang = langs[doc]
        each = np.fromiter(map(hashes.__getitem__, self.words), np.uint64, len(self.words))
        self.one = _mixed(each ^ seeds[self.lang])

    def grams(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first words, hashes) of the n-grams inside pieces, for n up to ``most``."""
        at, h = np.arange(len(self.one)), self.one
        for n in range(1, most + 1):
            if n > 1:
                inside = at[at + n - 1 < len(self.one)]
                h = h[:len(inside)]
                same = self.piece[inside] == self.piece[inside + n - 1]
                at, h = inside[same], h[same]
                h = _mixed(h * _ODD + self.one[at + n - 1])
            yield n, at, h


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, list[str]]]:
    """Chunks of (lang, text) batches, with the names of their languages."""
    hashes = _Words()
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        names = coded.dictionary.to_pylist()
        seeds = np.array([xxhash.xxh64_intdigest(x.encode(), 1) for x in names], np.uint64)
        langs = coded.indices.to_numpy(zero_copy_only=False)
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        first = 0
        while first < len(texts):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
            yield Chunk(texts[first:last], langs[first:last], seeds, hashes), names
            first = last


class Held:
    """A set of hashes, searched in two steps."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sorted = np.sort(hashes)
        self.some = np.zeros(1 << 22, bool)
        self.some[(self.sorted >> np.uint64(42)).astype(np.int64)] = True

    def __contains__(self, hashes) -> bool:
        raise TypeError("use has()")

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = self.some[(hashes >> np.uint64(42)).astype(np.int64)]
        at = np.flatnonzero(found)
        if len(self.sorted) and len(at):
            place = np.minimum(np.searchsorted(self.sorted, hashes[at]), len(self.sorted) - 1)
            found[at] = self.sorted[place] == hashes[at]
        return found


def packed(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values."""
    held = pa.py_buffer(np.ascontiguousarray(values))
    offsets = pa.py_buffer((edge * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, offsets, held])


def tallied(batches: Iterator[pa.RecordBatch], parts: int, sizes: range, pairs: Held | None) -> Iterator[pa.RecordBatch]:
    """(slot, mass, hashes, counts): tallies of n-grams by hash partition, and what each partition got.

    A row of slot 2 x partition + 1 holds a tally, as packed numbers, one of slot 2 x partition
    the occurrences. With ``pairs``, n-grams whose pairs are not all among them are left out.
    """
    names, mass = ["slot", "mass", "hashes", "counts"], np.zeros(parts, np.int64)
    kept: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(kept), return_counts=True)
        part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        kept.clear()
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        edge, own = np.append(first, len(h)), part[first]
        mass[own] += np.add.reduceat(n, first)
        return pa.RecordBatch.from_arrays(
            [pa.array(own * 2 + 1), pa.nulls(len(own), pa.int64()), packed(h, edge), packed(n.astype(np.uint32), edge)],
            names=names,
        )

    for chunk, _ in chunks(batches):
        good = None
        for n, at, h in chunk.grams(sizes[-1]):
            if n == 2 and pairs is not None:
                good = np.zeros(len(chunk.one), bool)
                good[at[pairs.has(h)]] = True
            if n in sizes:
                if good is not None:
                    some = np.ones(len(at), bool)
                    for i in range(n - 1):
                        some &= good[at + i]
                    h = h[some]
                kept.append(h)
        if sum(map(len, kept)) >= TALLY:
            yield flush()
    if sum(map(len, kept)):
        yield flush()
    own = np.flatnonzero(mass)
    none = pa.nulls(len(own), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(own * 2), pa.array(mass[own]), none, none], names=names)


class Summary:
    """Misra-Gries counters of one hash partition, merged from tallies."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.short = capacity, 0
        self.hashes, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, counts))
        self.n_waiting += len(hashes)
        if self.n_waiting > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        hashes = np.concatenate([self.hashes, *(h for h, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(n for _, n in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else []
        self.hashes, self.counts = hashes[first], np.add.reduceat(counts, first) if len(first) else counts
        over = len(self.counts) - self.capacity
        if over > 0:
            off = np.partition(self.counts, over - 1)[over - 1]
            self.short += int(off)
            stay = self.counts > off
            self.hashes, self.counts = self.hashes[stay], self.counts[stay] - off

    def frequent(self, least: int) -> np.ndarray:
        """Hashes that may occur ``least`` times; none that does is missing."""
        self.merge()
        return self.hashes[self.counts + self.short >= least]


def summarised(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Survivors of the hash partitions of tallies sorted by slot."""
    part, mass, summary = -1, 0, None

    def done() -> Iterator[pa.RecordBatch]:
        if summary is not None:
            yield pa.RecordBatch.from_arrays([pa.array(summary.frequent(least))], names=["hash"])

    for batch in batches:
        slots, masses = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for i, slot in enumerate(slots.tolist()):
            if slot >> 1 != part:
                yield from done()
                part, mass, summary = slot >> 1, 0, None
            if slot & 1 == 0:
                mass += int(masses[i])
            else:
                summary = summary or Summary(mass // least + 1)
                hashes, counts = (batch.column(c)[i].as_buffer() for c in (2, 3))
                summary.add(np.frombuffer(hashes, np.int64), np.frombuffer(counts, np.uint32).astype(np.int64))
    yield from done()


def survivors(texts: DataFrame, parts: int, sizes: range, least: int, pairs) -> DataFrame:
    """(hash) of the n-grams that may occur ``least`` times, written."""
    tallies = texts.mapInArrow(
        lambda b: tallied(b, parts, sizes, pairs.value if pairs else None), "slot bigint, mass bigint, hashes binary, counts binary"
    )
    dealt = tallies.repartition(F.shiftright("slot", 1)).sortWithinPartitions("slot")
    return stash(dealt.mapInArrow(lambda b: summarised(b, least), "hash bigint"), "survivors")


def held(found: DataFrame, most: int):
    """The hashes as a broadcast set, or None if they are more than ``most``."""
    if found.count() > most:
        return None
    hashes = found.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64)
    return found.sparkSession.sparkContext.broadcast(Held(hashes))


def counted(batches: Iterator[pa.RecordBatch], longest: int, wanted: Held | None) -> Iterator[pa.RecordBatch]:
    """(lang, size, phrase, hash, n) of a chunk's n-grams; size 0 counts all words of a language."""
    names = ["lang", "size", "phrase", "hash", "n"]
    for chunk, langs in chunks(batches):
        total = np.bincount(chunk.lang, minlength=len(langs))
        named = {w: i for i, w in enumerate(dict.fromkeys(chunk.words))}
        ids = np.fromiter(map(named.__getitem__, chunk.words), np.int32, len(chunk.words))
        yield pa.RecordBatch.from_arrays([
            pa.array(langs, pa.string()), pa.array(np.zeros(len(langs), np.int32)), pa.nulls(len(langs), pa.string()),
            pa.nulls(len(langs), pa.int64()), pa.array(total.astype(np.int64)),
        ], names=names)
        for n, at, h in chunk.grams(longest):
            if wanted is not None:
                some = wanted.has(h)
                at, h = at[some], h[some]
            if not len(at):
                continue
            order = np.argsort(h)
            at, h = at[order], h[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            size = np.diff(np.append(first, len(h)))
            like = np.repeat(at[first], size)
            same = chunk.lang[at] == chunk.lang[like]
            for i in range(n):
                same &= ids[at + i] == ids[like + i]
            # Other words under one hash are rows of their own.
            odd = np.flatnonzero(~same)
            many = np.append(np.add.reduceat(same.astype(np.int64), first), np.ones(len(odd), np.int64))
            one = np.append(at[first], at[odd])
            words = chunk.words
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[i] for i in chunk.lang[one]], pa.string()), pa.array(np.full(len(one), n, np.int32)),
                pa.array([b" ".join(words[i:i + n]) for i in one.tolist()], pa.binary()).cast(pa.string()),
                pa.array(np.append(h[first], h[odd]).view(np.int64)), pa.array(many),
            ], names=names)


class Sums:
    """Counts of alike rows, added up whenever over ``SUMMED`` bytes have come; the last column is ``n``."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.held: list[pa.RecordBatch] = []
        self.size, self.limit = 0, SUMMED

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.size += batch.nbytes
        if self.size > self.limit:
            self.held = self.table().to_batches()
            self.size = sum(b.nbytes for b in self.held)
            self.limit = max(SUMMED, 2 * self.size)

    def table(self) -> pa.Table:
        rows = pa.Table.from_batches(self.held)
        *keys, n = rows.column_names
        found = rows.group_by(keys, use_threads=False).aggregate([(n, "sum")])
        return found.select([*keys, f"{n}_sum"]).rename_columns([*keys, n])


def dealt(batches: Iterator[pa.RecordBatch], parts: int, longest: int, wanted: Held) -> Iterator[pa.RecordBatch]:
    """(part, langs, sizes, phrases, counts): what ``counted`` finds in a task, a row for each hash partition.

    The numbers of all words are in the first partition.
    """
    sums = Sums()

    def flush() -> pa.RecordBatch:
        table = sums.table()
        sums.clear()
        h = table["hash"].fill_null(0).combine_chunks().to_numpy().view(np.uint64)
        part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, table = part[order], table.drop_columns("hash").take(order).combine_chunks()
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        edge = pa.array(np.append(first, len(part)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(edge, c.combine_chunks()) for c in table.columns]
        return pa.RecordBatch.from_arrays([pa.array(part[first]), *lists], names=["part", "langs", "sizes", "phrases", "counts"])

    for batch in counted(batches, longest, wanted):
        sums.add(batch)
        if sums.limit > SUMMED:
            yield flush()
    if sums.held:
        yield flush()


def added(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(lang, size, phrase, n) of rows of ``dealt`` sorted by part: the totals, and what occurs ``least`` times."""
    part, sums = -1, Sums()

    def done() -> Iterator[pa.RecordBatch]:
        if sums.held:
            table = sums.table()
            yield from table.filter((pc.field("size") == 0) | (pc.field("n") >= least)).to_batches()
            sums.clear()

    for batch in batches:
        for i, own in enumerate(batch.column(0).to_pylist()):
            if own != part:
                yield from done()
                part = own
            sums.add(pa.RecordBatch.from_arrays(
                [batch.column(c)[i].values for c in range(1, 5)], names=["lang", "size", "phrase", "n"]
            ))
    yield from done()


def frequent_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, most: int = HELD
) -> DataFrame:
    """(lang, size, phrase, n), written: phrases of up to ``longest`` words that occur ``least`` times, exactly.

    Rows of size 0, with a NULL phrase, hold the number of all words of a language.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # At most one word in two bytes, as a word and as a pair.
    parts = max(PARTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // (least * COUNTERS) + 1)
    short = survivors(texts, parts, range(1, min(2, longest) + 1), least, None)
    found = short
    if longest > 2:
        pairs = held(short, most)
        longer = survivors(texts, parts, range(3, longest + 1), least, pairs)
        found = short.unionByName(longer)
    wanted = held(found, most)
    if wanted is None:
        rows = texts.mapInArrow(
            lambda b: counted(b, longest, None), "lang string, size int, phrase string, hash bigint, n bigint"
        )
        known = rows.filter(F.col("size") > 0).join(found.distinct(), "hash", "left_semi")
        rows = rows.filter(F.col("size") == 0).unionByName(known.select(rows.columns))
        counts = rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
        counts = counts.filter((F.col("size") == 0) | (F.col("n") >= least))
    else:
        own = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        tallies = texts.mapInArrow(
            lambda b: dealt(b, own, longest, wanted.value),
            "part int, langs array<string>, sizes array<int>, phrases array<string>, counts array<bigint>",
        )
        counts = tallies.repartition("part").sortWithinPartitions("part").mapInArrow(
            lambda b: added(b, least), "lang string, size int, phrase string, n bigint"
        )
    done = stash(counts, "phrases")
    release(short)
    if longest > 2:
        release(longer)
    return done


def _part(words: Column, first: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(words, F.lit(first) if isinstance(first, int) else first, length), " ")


def _band(score: Column) -> Column:
    """Bands of scores: how many bits, then the four bits after the first."""
    bits = F.length(F.bin(score))
    return (bits * 16 + F.pmod(F.expr("shiftright(score, greatest(length(bin(score)) - 5, 0))"), F.lit(16))).cast("int")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text",
    least: int = LEAST, longest: int = LONGEST, top: int = TOP, most: int = HELD,
) -> DataFrame:
    r"""(lang, rank, phrase, a, l, r, n, score): each language's first phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z) and cut into pieces at ``[.,;:!?\x0A-\x0D]``, pieces into words
    ``[^\x20\x09]+``. ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n``
    all words of the language; the score is floor(1000 a n / (l r)), worked out in decimals. A phrase
    inside a longer one that occurs as often is left out. Order: score, then ``a``, both falling, then
    the phrase by bytes.

    A NULL language counts as ``und``, NULL texts as empty. Empty texts, languages without frequent
    phrases and empty tables give no rows; repeated rows count each time. Other columns are not read.
    Texts are taken whole; a piece is never cut, however long.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    counts = frequent_phrases(docs, lang, text, least, longest, most)
    totals = counts.filter(F.col("size") == 0).select("lang", F.col("n").alias("total"))
    if totals.count() <= LANGUAGES:
        totals = F.broadcast(totals)
    known = counts.filter(F.col("size") > 0).select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    candidates = counts.filter(F.col("size") > 1).select("lang", "size", "phrase", F.col("n").alias("a"), words.alias("w"))

    # A longer phrase that occurs as often has all phrases between the two occur as often.
    inside = F.array(_part(F.col("w"), 1, F.col("size") - 1), _part(F.col("w"), 2, F.col("size") - 1))
    covered = (
        candidates.filter(F.col("size") > 2).select("lang", F.explode(inside).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("by"))
    )
    left = candidates.join(covered, ["lang", "phrase"], "left").filter(F.coalesce("by", F.lit(0)) < F.col("a"))

    cuts = left.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part(F.col("w"), 1, F.col("k")).alias("head"),
        _part(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    scored = (
        cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
        .join(known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
        .join(totals, "lang")
        .withColumn("score", F.expr(
            "(cast(1000 as decimal(38,0)) * a * total) div (cast(l as decimal(38,0)) * cast(r as decimal(19,0)))"
        ))
    )
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "total")).alias("best")
    ).select("lang", "phrase", "best.*")
    best = stash(best.withColumn("band", _band(F.col("score"))), "scored")

    # Only bands that can hold one of the first are ordered.
    above = Window.partitionBy("lang").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        best.groupBy("lang", "band").count()
        .filter(F.col("count") > 0).withColumn("above", F.coalesce(F.sum("count").over(above), F.lit(0)))
        .filter(F.col("above") < top).select("lang", "band")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.join(cut, ["lang", "band"], "left_semi").withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    )

"""Language of pages, from text, markup and address together.

Four kinds of evidence are fused by Bayes' rule. The text gives each language a
likelihood, from counts of byte trigrams of labelled texts; one more class, ``und``,
has all trigrams equally likely and takes what no known language explains. The
declared language and the suffix of the address have likelihoods P(value | language).
The host gives the prior: its counts of languages, smoothed towards those of its
domain, and these towards those of all pages.

Counts of the last three come from the pages themselves, by grouped aggregation of
what the text alone says of each page. A page's own share is taken out of its host's
counts before they serve as its prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rategrid.llm.features import Hashes, pieces, row_sums, utf8
from rategrid.llm.sample import SPARE
from rategrid.llm.store import stash

UNKNOWN = "und"
GRAM = 3
BITS = 14
#: Labelled texts a language is learnt from, at most.
SAMPLE = 1000
#: Trigrams overlap, so they count as a third each, and no more than so many in all.
SHARE, MOST = 1 / 3, 300
#: Added to counts of languages, in pages, where a level is smoothed by the one above.
SMOOTH = 5.0
#: Of the likelihood of a declared value or suffix, given a language.
ADD = 0.5
#: Trigrams of a single text say more of that text, which may be labelled wrongly, than of
#: the language: they don't count, once a language has so many texts.
TEXTS = 10
#: Share of the uniform distribution in each language's, so that a few odd trigrams decide little.
MIXED = 0.2
#: Prior share of ``und`` where nothing is known.
UNKNOWN_SHARE = 1e-4
#: Least probability of the language of a kept document.
SURE = 0.5


class Model(NamedTuple):
    languages: list[str]
    #: Log probability by language and trigram; ``und`` is the last row.
    log: np.ndarray


def grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, trigram buckets, where each text's begin) of lower-cased texts; digits take no part."""
    held, offsets = utf8(pc.utf8_lower(texts.fill_null("")))
    for first, part, ends in pieces(held, offsets):
        found = (Hashes(part).grams(GRAM) >> np.uint64(64 - BITS)).astype(np.int64)
        at = np.minimum(ends, len(found))
        across = np.zeros(len(found), bool)
        for i in range(1, GRAM):
            across[np.clip(ends[1:-1] - i, 0, None)[ends[1:-1] - i < len(found)]] = True
        digit = (part >= 0x30) & (part <= 0x39)
        for i in range(GRAM):
            across |= digit[i:i + len(found)]
        if across.any():
            kept = np.concatenate(([0], np.cumsum(~across)))
            found, at = found[~across], kept[at]
        yield first, found, at


def lowest(rows: DataFrame, most: int) -> DataFrame:
    """Distinct (lang, order) in which every language has its ``most`` smallest orders, and few others.

    A language with many texts takes part with those below a threshold only, some ``SPARE``
    times as many as asked for, so none has to be ordered whole in one task.
    """
    hashes = stash(rows.select("lang", "order").distinct(), "hashes")
    counts = {r["lang"]: r["count"] for r in hashes.groupBy("lang").count().collect()}
    below = {x: int(-(1 << 63) + (1 << 64) * (SPARE * most / n)) for x, n in counts.items() if n > 2 * SPARE * most}
    if not below:
        return hashes
    spark = rows.sparkSession
    limits = lambda: F.broadcast(spark.createDataFrame(sorted(below.items()), "lang string, below bigint"))
    few = lambda: hashes.join(limits(), "lang", "left").filter(
        F.col("below").isNull() | (F.col("order") < F.col("below"))
    ).drop("below")
    left = {r["lang"]: r["count"] for r in few().groupBy("lang").count().collect()}
    for x in [x for x in below if left.get(x, 0) < most]:
        del below[x]
    return few() if below else hashes


def train(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = SAMPLE) -> Model:
    """Count trigrams of at most ``most`` labelled texts of a language, chosen by hash.

    Every language that has a labelled text is learnt; the tables that reach the driver
    have one row for each of these and each bucket.
    """
    order = F.xxhash64(text)
    rows = docs.filter(F.col(lang).isNotNull() & (F.col(lang) != "")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), order.alias("order")
    )
    found = rows.groupBy("lang").count().collect()
    names = sorted(r["lang"] for r in found)
    # Ranked on hashes alone; the texts of the chosen are joined afterwards.
    first = Window.partitionBy("lang").orderBy("order")
    chosen = (
        lowest(rows, most).withColumn("nth", F.row_number().over(first))
        .filter(F.col("nth") <= most).select("lang", "order")
    )
    place = {n: i for i, n in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [place[x] for x in batch.column(0).to_pylist()]
            cells, copies = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for start, buckets, ends in grams(batch.column(1)):
                for i in range(len(ends) - 1):
                    bucket, n = np.unique(buckets[ends[i]:ends[i + 1]], return_counts=True)
                    cells.append((at[start + i] << BITS) + bucket)
                    copies.append(n)
            cell, back = np.unique(np.concatenate(cells), return_inverse=True)
            total = np.bincount(back, np.concatenate(copies), len(cell)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell >> BITS), pa.array(cell & ((1 << BITS) - 1)), pa.array(total),
                 pa.array(np.bincount(back, minlength=len(cell)))],
                names=["place", "bucket", "n", "texts"],
            )

    counts = np.zeros((len(names), 1 << BITS))
    if names:
        # Copies of a chosen text count once.
        table = (
            rows.join(F.broadcast(chosen), ["lang", "order"])
            .groupBy("lang", "order").agg(F.first("text").alias("text")).select("lang", "text")
            .mapInArrow(count, "place bigint, bucket bigint, n bigint, texts bigint")
            .groupBy("place", "bucket").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
        )
        many = np.array([min(r["count"], most) >= TEXTS for r in sorted(found, key=lambda r: r["lang"])])
        held = {c: column.to_numpy() for c, column in zip(table.columns, table.toArrow().columns, strict=True)}
        kept = (held["texts"] > 1) | ~many[held["place"]]
        counts[held["place"][kept], held["bucket"][kept]] = held["n"][kept]
    even = 1 / (1 << BITS)
    own = (counts + ADD) / (counts.sum(1, keepdims=True) + ADD * (1 << BITS))
    log = np.log((1 - MIXED) * own + MIXED * even)
    return Model([*names, UNKNOWN], np.vstack([log, np.full((1, 1 << BITS), -BITS * np.log(2))]))


def text_evidence(rows: DataFrame, model: Model, text: str) -> DataFrame:
    """Replace the text by ``said``, log likelihoods by language, and ``p``, their probabilities alone."""
    at = rows.columns.index(text)
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "said array<double>", "p array<double>"])
    held = rows.sparkSession.sparkContext.broadcast(model.log)

    def say(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = held.value.astype(np.float32)
        for batch in batches:
            sums, n = np.zeros((batch.num_rows, len(log))), np.zeros(batch.num_rows)
            for first, found, ends in grams(batch.column(at)):
                part = slice(first, first + len(ends) - 1)
                n[part] += np.diff(ends)
                for i in range(len(log)):
                    sums[part, i] += row_sums(log[i][found], ends)
            weight = np.minimum(n * SHARE, MOST) / np.maximum(n, 1)
            sums *= weight[:, None]
            sums -= sums.max(1, initial=-np.inf, keepdims=True)
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (sums, normed(sums))]
            yield pa.RecordBatch.from_arrays(
                [*(c for i, c in enumerate(batch.columns) if i != at), *lists],
                names=[*(f.name for f in kept), "said", "p"],
            )

    return rows.mapInArrow(say, schema)


def normed(logs: np.ndarray) -> np.ndarray:
    """Probabilities of log weights, by row."""
    raised = np.exp(logs - logs.max(1, initial=-np.inf, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


def rows_of(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _counts(rows: DataFrame, level: str, size: int, out: str) -> DataFrame:
    """(level, out): sums of the text's probabilities by language, for each value of a level."""
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(size)]
    found = rows.filter(F.col(level).isNotNull()).groupBy(level).agg(*sums)
    return found.select(level, F.array(*[f"s{i}" for i in range(size)]).alias(out))


def distinct_values(rows: DataFrame, column: str) -> int:
    """How many values a column has, NULL not counted."""
    return rows.filter(F.col(column).isNotNull()).select(column).distinct().count()


def identify(
    pages: DataFrame, model: Model, key: str, text: str,
    declared: str | None = None, suffix: str | None = None,
    host: str | None = None, domain: str | None = None,
) -> DataFrame:
    """(key, lang, confidence, text_lang) per row.

    Evidence that a table or a row lacks (NULL) is left out; a text without trigrams
    says nothing, so the rest decides. ``und`` has the row that nothing explains.
    Repeated rows give repeated rows, an empty table an empty one.
    """
    size = len(model.languages)
    nothing = F.lit(None).cast("string")
    rows = pages.select(
        F.col(key).alias("key"), F.col(text).alias("text"),
        *[(F.col(c).cast("string") if c else nothing).alias(n) for n, c in (
            ("declared", declared), ("suffix", suffix), ("host", host), ("domain", domain))],
    )
    said = stash(text_evidence(rows, model, "text"), "said")
    # One row: counts over all pages.
    everything = _counts(said.withColumn("all", F.lit(0)), "all", size, "n").first()
    base = np.full(size, 1.0)
    base[-1] = 0
    base = base / max(1, size - 1)
    base[-1] = UNKNOWN_SHARE
    total = np.array(everything["n"]) if everything else np.zeros(size)
    prior = (total + SMOOTH * base) / (total.sum() + SMOOTH * base.sum())
    # Distinct values of a kind of evidence, for its smoothing.
    kinds = {c: distinct_values(said, c) for c in ("declared", "suffix")}
    zero = F.array(*[F.lit(0.0)] * size)
    levels = ("declared", "suffix", "domain", "host")
    found = said
    for level in levels:
        found = found.join(_counts(said, level, size, f"n_{level}"), level, "left")
    # Lists are never NULL here: a level without a value has no counts.
    found = found.select(
        "key", "said", "p", *[F.coalesce(f"n_{c}", zero).alias(f"n_{c}") for c in levels],
        *[F.isnotnull(c).alias(f"has_{c}") for c in ("declared", "suffix")],
    )
    names = np.array(model.languages, object)

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            said, p, *counts = (rows_of(batch.column(i), size) for i in range(1, 7))
            # A page is no evidence for itself.
            declared, suffix, domain, host = (np.maximum(n - p, 0) for n in counts)

            def likely(n: np.ndarray, kind: str, given: pa.Array) -> np.ndarray:
                per = np.log((n + ADD) / (np.maximum(total - 1, 0) + ADD * (kinds[kind] + 1)))
                return np.where(given.to_numpy(zero_copy_only=False)[:, None], per, 0)

            by_domain = (domain + SMOOTH * prior) / (domain.sum(1, keepdims=True) + SMOOTH)
            by_host = (host + SMOOTH * by_domain) / (host.sum(1, keepdims=True) + SMOOTH)
            q = normed(
                said + np.log(by_host) + likely(declared, "declared", batch.column(7))
                + likely(suffix, "suffix", batch.column(8))
            )
            alone = np.where(said.min(1) == said.max(1), size - 1, said.argmax(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[q.argmax(1)], pa.string()), pa.array(q.max(1)),
                 pa.array(names[alone], pa.string())],
                names=["key", "lang", "confidence", "text_lang"],
            )

    schema = T.StructType([
        found.schema["key"], T.StructField("lang", T.StringType()),
        T.StructField("confidence", T.DoubleType()), T.StructField("text_lang", T.StringType()),
    ])
    return found.mapInArrow(fuse, schema).withColumnRenamed("key", key)


def keep_known(docs: DataFrame, model: Model, text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``SURE`` probability.

    Rows are told apart by all their columns of evidence, so a decision is that of
    the text, its declared language and its host; repeated rows share it.
    """
    mark = "__row"
    while mark in docs.columns:
        mark += "_"
    parts = [x for c in (text, declared, host) for x in (F.col(c), F.isnull(c))]
    rowed = docs.withColumn(mark, F.struct(
        F.xxhash64(*parts, F.lit(1)).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b")
    ))
    found = identify(rowed, model, mark, text, declared=declared, host=host)
    kept = found.filter((F.col("lang") != UNKNOWN) & (F.col("confidence") >= SURE)).select(mark).distinct()
    return rowed.join(kept, mark, "left_semi").select(docs.columns)

"""Quality scores by supervised subword embeddings.

Words and byte n-grams are hashed into rows of one embedding matrix, and a word that
repeats the word before it into one more. A document is the mean of the vectors of
all its features; a softmax layer tells the two classes apart. Matrix and layer are
learnt together by stochastic gradient descent on a bounded sample of the labelled
documents. As the mean is linear, scoring needs one number per bucket: the
difference of the two classes after the layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rategrid.llm.features import Hashes, gram_rows, held_out, pieces, row_sums, utf8, word_spans
from rategrid.llm.sample import smallest

BUCKET_BITS = 16
GRAMS = (3, 4)
#: Labelled documents that the model is fitted on, at most.
SAMPLE = 6000
DIMENSIONS = 8
EPOCHS = 8
RATE = 0.25
THRESHOLD = 0.3


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def buckets(held: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each feature, features before each text) for each kind of feature."""
    hashes, shift = Hashes(held), np.uint64(64 - BUCKET_BITS)
    for n in GRAMS:
        grams = (hashes.grams(n) >> shift).astype(np.int64)
        _, across = gram_rows(offsets, n, len(grams))
        ends = np.minimum(offsets, len(grams))
        if across.any():
            kept = np.concatenate(([0], np.cumsum(~across)))
            yield grams[~across], kept[ends]
        else:
            yield grams, ends
    starts, stops, rows = word_spans(held, offsets)
    found = hashes.spans(starts, stops)
    at = np.searchsorted(rows, np.arange(len(offsets)))
    yield (found >> shift).astype(np.int64), at
    again = np.flatnonzero((found[1:] == found[:-1]) & (rows[1:] == rows[:-1])) + 1
    yield np.full(len(again), 1 << BUCKET_BITS), np.searchsorted(rows[again], np.arange(len(offsets)))


def counted(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, share of the features) of each text."""
    held, offsets = utf8(texts)
    out: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
    for first, part, ends in pieces(held, offsets):
        for found, at in buckets(part, ends):
            for i in range(len(ends) - 1):
                out[first + i].append(found[at[i]:at[i + 1]].astype(np.int32))
    sparse = []
    for parts in out:
        found, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.int32), return_counts=True)
        sparse.append((found, n / max(1, n.sum())))
    return sparse


def fit(
    examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
    dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7,
) -> Model:
    """Stochastic gradient descent, one document a step, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, ((1 << BUCKET_BITS) + 1, dimensions)) / dimensions
    layer, bias = np.zeros((dimensions, 2)), np.zeros(2)
    share = np.bincount(labels, minlength=2) / max(1, len(labels))
    bias[:] = np.log(np.maximum(share, 1e-3))
    steps, done = max(1, epochs * len(labels)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            at, x = examples[i]
            now = rate * (1 - done / steps)
            done += 1
            hidden = x @ vectors[at]
            z = np.clip(hidden @ layer + bias, -30, 30)
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= now * np.outer(hidden, p)
            bias -= 0.1 * now * p
            # Scaled by the number of features, or frequent and rare ones would barely move.
            vectors[at] -= (now * len(at) * x)[:, None] * back
    apart = layer[:, 1] - layer[:, 0]
    return Model((vectors @ apart).astype(np.float32), float(bias[1] - bias[0]))


def logits(texts: pa.Array, model: Model) -> np.ndarray:
    """Log odds of label 1 for each text; a text without features has the bias alone."""
    held, offsets = utf8(texts)
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    for first, part, ends in pieces(held, offsets):
        rows = slice(first, first + len(ends) - 1)
        for found, at in buckets(part, ends):
            sums[rows] += row_sums(model.weights[found], at)
            counts[rows] += np.diff(at)
    return sums / np.maximum(counts, 1) + model.bias


def sample(labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """(key, label, order): at most so many labelled keys that are not held out, by hash."""
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .withColumn("order", F.xxhash64("key", F.lit(4)))
    )
    return smallest(known, "order", most, "key", "label")


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", most: int = SAMPLE,
) -> Model:
    """Fit on at most ``most`` labelled documents that are not held out.

    Features are worked out where the documents are; one task fits the model. Without
    examples of a class the score is near the share of the other.
    """
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        F.broadcast(sample(labels, key, label, most)), "key"
    )

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = counted(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()),
                 pa.array([x.astype(np.float32).tobytes() for _, x in found], pa.binary())],
                names=["label", "order", "at", "share"],
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, known = [], []
        for batch in batches:
            for y, at, x in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                examples.append((np.frombuffer(at, np.int32), np.frombuffer(x, np.float32)))
                known.append(int(y > 0))
        if examples:
            model = fit(examples, np.array(known))
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"]
            )

    found = (
        chosen.select("text", "label", "order")
        .mapInArrow(featured, "label int, order bigint, at binary, share binary")
        .repartition(1).sortWithinPartitions("order", "label", "at", "share")
        .mapInArrow(fitted, "weights binary, bias double").collect()
    )
    if not found:
        return Model(np.zeros((1 << BUCKET_BITS) + 1, np.float32), 0.0)
    return Model(np.frombuffer(bytes(found[0]["weights"]), np.float32), found[0]["bias"])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of label 1. NULL and empty texts get that of the bias.

    A column that is called ``out`` already is replaced; texts are taken whole, of any length.
    Repeated rows give repeated rows, an empty table an empty one.
    """
    if out == text:
        raise ValueError("the score needs another column than the text")
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-np.clip(logits(batch.column(at), model), -50, 50)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=schema.names)

    return docs.mapInArrow(add, schema)


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, with the columns they have."""
    at, schema = docs.columns.index(text), docs.schema
    least = np.log(threshold / (1 - threshold))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(logits(batch.column(at), model) >= least))

    return docs.mapInArrow(keep, schema)

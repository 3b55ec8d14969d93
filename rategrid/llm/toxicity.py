"""Toxicity scores from the nearest labelled examples, by exact TF-IDF cosine.

Terms are words and their leading four and six bytes. The vocabulary holds the terms
that go with a label beyond chance, by chi-square over a bounded sample of labelled
documents; document frequencies of these are counted over all documents. All other
words of a document are part of its length, not of its direction: they lower every
cosine, so a known term weighs less in a long text.

The examples stand in an inverted index: for each term its postings, cut into blocks
of examples, with the largest weight in each block. For a document the largest
possible cosine of every block follows from those maxima; blocks are opened in that
order, until the next can't reach the k nearest found so far. The result is that of
comparing with every example.

The vote of a neighbour counts by its distance, beside a fixed vote for neither label,
so far neighbours decide little. Votes turn into probabilities by
isotonic regression over the examples, each left out of its own vote, weighted to the
share that both labels have among all labelled rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rategrid.llm.features import Hashes, held_out, pieces, utf8, word_spans
from rategrid.llm.sample import smallest

#: Labelled documents in the index, at most, by label; terms, at most.
TOXIC, CLEAN = 2000, 4000
TERMS = 4096
#: Of the terms taken into the vocabulary, as many may be there by chance.
CHANCE = 0.5
LEADING = (4, 6)
NEIGHBOURS = 16
BLOCK = 64
NEAR = 0.05
#: Weight of the vote for neither label, and of a word outside the vocabulary.
NEITHER = 1.0
OTHER = 0.02
THRESHOLD = 0.5


def terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, row, term, words) of all terms of lower-cased texts, a piece at a time.

    The first ``words`` of the terms are the words themselves.
    """
    held, offsets = utf8(pc.utf8_lower(texts.fill_null("")))
    for first, part, ends in pieces(held, offsets):
        hashes = Hashes(part)
        starts, stops, rows = word_spans(part, ends)
        found, at = [hashes.spans(starts, stops)], [rows]
        for n in LEADING:
            longer = stops - starts > n
            lead = hashes.spans(starts[longer], starts[longer] + n)
            found.append(lead ^ np.uint64(n))
            at.append(rows[longer])
        yield first, np.concatenate(at), np.concatenate(found), len(starts)


class Counts(NamedTuple):
    """Places of known terms in the vocabulary, in order, how often they occur, and words in all."""

    at: np.ndarray
    n: np.ndarray
    words: int


class Vocabulary:
    """Positions of known terms; a table of 16 leading bits passes by most others."""

    def __init__(self, known: np.ndarray) -> None:
        self.known = np.sort(known)
        self.may = np.zeros(1 << 16, bool)
        self.may[(self.known >> np.uint64(48)).astype(np.int64)] = True

    def counts(self, texts: pa.Array) -> list[Counts]:
        """The known terms of each text."""
        size = max(1, len(self.known))
        pairs, words = [], np.zeros(len(texts), np.int64)
        for first, rows, found, n in terms(texts):
            words[first:] += np.bincount(rows[:n], minlength=len(texts) - first)
            may = np.flatnonzero(self.may[(found >> np.uint64(48)).astype(np.int64)])
            rows, found = rows[may], found[may]
            at = np.minimum(np.searchsorted(self.known, found), size - 1)
            hit = self.known[at] == found if len(self.known) else np.zeros(0, bool)
            pairs.append((rows[hit] + first) * size + at[hit])
        pairs, n = np.unique(np.concatenate(pairs) if pairs else np.empty(0, np.int64), return_counts=True)
        cut = np.searchsorted(pairs // size, np.arange(len(texts) + 1))
        return [
            Counts(pairs[a:b] % size, n[a:b], int(w))
            for a, b, w in zip(cut[:-1], cut[1:], words, strict=True)
        ]


class Index(NamedTuple):
    """Examples in postings by term; within a term by block of examples."""

    keys: list
    labels: np.ndarray
    #: Of term t: examples[at[t]:at[t + 1]] and their weights; blocks as places there.
    at: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    #: blocks[t, b]: where block b of term t begins; most[t, b]: its largest weight.
    blocks: np.ndarray
    most: np.ndarray


def weighted(found: Counts, idf: np.ndarray) -> np.ndarray:
    w = found.n * idf[found.at]
    return w / np.sqrt(w @ w + (OTHER * found.words) ** 2) if len(w) else w


def build(vectors: list[tuple[np.ndarray, np.ndarray]], keys: list, labels: np.ndarray, size: int) -> Index:
    """The index of weighted vectors. Examples with the same strongest term stand together."""
    strongest = [int(at[np.argmax(w)]) if len(w) else -1 for at, w in vectors]
    order = sorted(range(len(vectors)), key=lambda i: (strongest[i], i))
    postings: list[list[tuple[int, float]]] = [[] for _ in range(size)]
    for place, i in enumerate(order):
        for t, w in zip(*vectors[i], strict=True):
            postings[int(t)].append((place, float(w)))
    at = np.concatenate(([0], np.cumsum([len(p) for p in postings]))).astype(np.int64)
    examples = np.array([e for p in postings for e, _ in p], np.int64)
    weights = np.array([w for p in postings for _, w in p])
    n = -(-len(order) // BLOCK)
    blocks, most = np.zeros((size, n + 1), np.int64), np.zeros((size, n))
    for t in range(size):
        part = examples[at[t]:at[t + 1]] // BLOCK
        blocks[t] = at[t] + np.searchsorted(part, np.arange(n + 1))
        np.maximum.at(most[t], part, weights[at[t]:at[t + 1]])
    return Index([keys[i] for i in order], labels[order], at, examples, weights, blocks, most)


def nearest(index: Index, at: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
    """(examples, cosines): the k most similar with a cosine above 0, ties by place in the index."""
    none = np.empty(0, np.int64), np.empty(0)
    if not len(at):
        return none
    bound = w @ index.most[at]
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    found, scores, least = none[0], none[1], 0.0
    for first in range(0, len(order), 4):
        part = order[first:first + 4]
        # A block that can only equal the last one kept may still hold an earlier example.
        part = part[bound[part] >= least - 1e-12]
        if not len(part):
            break
        total = np.zeros((len(part), BLOCK))
        for t, x in zip(at.tolist(), w.tolist(), strict=True):
            for row, b in enumerate(part.tolist()):
                a, z = index.blocks[t, b], index.blocks[t, b + 1]
                if z > a:
                    total[row, index.examples[a:z] - b * BLOCK] += x * index.weights[a:z]
        row, place = np.nonzero(total)
        found = np.concatenate((found, part[row] * BLOCK + place))
        scores = np.concatenate((scores, total[row, place]))
        best = np.lexsort((found, -np.round(scores, 12)))[:k]
        found, scores = found[best], scores[best]
        if len(found) == k:
            least = scores[-1]
    return found, scores


def vote(labels: np.ndarray, scores: np.ndarray) -> float:
    near = np.clip(scores, 0, 1)
    pull = near / (1 - near + NEAR)
    return float(pull @ labels / (pull.sum() + NEITHER))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing steps (x, y) nearest to the weighted points."""
    levels, place = np.unique(x, return_inverse=True)
    weight = np.bincount(place, w)
    mean = np.bincount(place, w * y) / weight
    stack: list[list[float]] = []
    for m, v, last in zip(mean, weight, levels, strict=True):
        stack.append([m, v, last])
        while len(stack) > 1 and stack[-2][0] >= stack[-1][0]:
            m2, v2, last2 = stack.pop()
            m1, v1, _ = stack.pop()
            stack.append([(m1 * v1 + m2 * v2) / (v1 + v2), v1 + v2, last2])
    return np.array([s[2] for s in stack]), np.array([s[0] for s in stack])


class Model(NamedTuple):
    vocabulary: Vocabulary
    idf: np.ndarray
    index: Index
    #: Calibration of votes, and the score of a document without a neighbour.
    steps: np.ndarray
    values: np.ndarray
    alone: float

    def judge(self, counts: Counts) -> tuple[float, np.ndarray, np.ndarray]:
        found, scores = nearest(self.index, counts.at, weighted(counts, self.idf))
        if not len(found):
            return self.alone, found, scores
        v = vote(self.index.labels[found], scores)
        step = min(int(np.searchsorted(self.steps, v - 1e-9)), len(self.steps) - 1)
        return float(self.values[step]), found, scores


def calibrate(index: Index, vectors: list[tuple[np.ndarray, np.ndarray]], places: np.ndarray, share: float):
    """Steps and values from votes without oneself, and the score of those without neighbours."""
    labels = index.labels[places]
    weight = np.where(labels == 1, share / max(1, labels.sum()), (1 - share) / max(1, (labels == 0).sum()))
    x, y, w = [], [], []
    alone = [0.0, 0.0]
    for (at, v), me, label, own in zip(vectors, places, labels, weight, strict=True):
        found, scores = nearest(index, at, v, NEIGHBOURS + 1)
        other = found != me
        found, scores = found[other][:NEIGHBOURS], scores[other][:NEIGHBOURS]
        if len(found):
            x.append(vote(index.labels[found], scores))
            y.append(label)
            w.append(own)
        else:
            alone[0] += own * label
            alone[1] += own
    steps, values = isotonic(np.array(x), np.array(y, float), np.array(w)) if x else (np.zeros(1), np.full(1, share))
    prior = 1 / max(1, len(labels))
    return steps, values, (alone[0] + prior * share) / (alone[1] + prior)


def select(labels: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """Terms whose documents have other labels than chance, the strongest first if there are too many."""
    every, place = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_inverse=True)
    doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
    df = np.bincount(place, minlength=len(every)).astype(float)
    toxic = np.bincount(place, labels[doc].astype(float), minlength=len(every))
    n, pos = len(labels), float(labels.sum())
    expected = df * pos / max(n, 1)
    spread = df * (1 - df / max(n, 1)) * pos * (n - pos) / max(n, 1) ** 2
    chi = (toxic - expected) ** 2 / np.maximum(spread, 1e-9)
    often = df >= 3
    # The chi-square that CHANCE of so many terms reach by chance (tail of the normal distribution).
    tail = 2 * np.log(max(2.0, often.sum() / CHANCE))
    chosen = np.flatnonzero((chi >= tail - np.log(tail * np.pi / 2)) & often)
    chosen = chosen[np.lexsort((every[chosen], -chi[chosen]))][:TERMS]
    return np.sort(every[chosen])


def examples(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, toxic: int, clean: int) -> DataFrame:
    """(key, label, order, text) of the labelled sample; by hash, none of it held out."""
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("key"), (F.col(label) > 0).cast("int").alias("label")).distinct()
        .withColumn("order", F.xxhash64("key", F.lit(2)))
    )
    chosen = smallest(known.filter("label = 1"), "order", toxic, "key").unionByName(
        smallest(known.filter("label = 0"), "order", clean, "key")
    )
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "toxic", toxic: int = TOXIC, clean: int = CLEAN,
) -> Model:
    """Choose terms, count them over all documents, index the examples and calibrate.

    Terms of the examples are found where the documents are; one task chooses among
    them, and one indexes. Both see the bounded sample only.
    """
    sample = examples(docs, labels, key, text, label, toxic, clean)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            parts: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
            for first, rows, found, _ in terms(texts):
                order = np.argsort(rows, kind="stable")
                cut = np.searchsorted(rows[order], np.arange(len(texts) - first + 1))
                for i in np.flatnonzero(np.diff(cut)).tolist():
                    parts[first + i].append(found[order[cut[i]:cut[i + 1]]])
            held = [np.unique(np.concatenate(p)).tobytes() if p else b"" for p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(held, pa.binary())], names=["label", "order", "terms"]
            )

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = [], []
        for batch in batches:
            held += [np.frombuffer(b, np.uint64) for b in batch.column(2).to_pylist()]
            known += batch.column(0).to_pylist()
        found = select(np.array(known, np.int64), held)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["term"])

    rows = (
        sample.select("text", "label", "order").mapInArrow(distinct, "label int, order bigint, terms binary")
        .repartition(1).mapInArrow(chosen, "term bigint").collect()
    )
    vocabulary = Vocabulary(np.array([r["term"] for r in rows], np.int64).view(np.uint64))
    size = len(vocabulary.known)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size + 1, np.int64)
        for batch in batches:
            df[size] += batch.num_rows
            for found in vocabulary.counts(batch.column(0)):
                df[found.at] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(df)], names=["term", "n"])

    counts = docs.select(text).mapInArrow(frequencies, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(size + 1)
    for r in counts.collect():
        df[r["term"]] = r["n"]
    idf = np.log((1 + df[size]) / (1 + df[:size])) + 1
    # Both labels' shares among all rows that may be learnt from.
    share = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key))).agg(
        F.avg((F.col(label) > 0).cast("int"))
    ).first()[0] or 0.0

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = vocabulary.counts(batch.column(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([c.at.astype(np.int64).tobytes() for c in found], pa.binary()),
                 pa.array([c.n.astype(np.int64).tobytes() for c in found], pa.binary()),
                 pa.array([c.words for c in found], pa.int64())],
                names=["key", "label", "order", "at", "n", "words"],
            )

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, known, vectors = [], [], []
        for batch in batches:
            for k, y, at, n, w in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)), strict=True):
                found = Counts(np.frombuffer(at, np.int64), np.frombuffer(n, np.int64), w)
                keys.append(k)
                known.append(y)
                vectors.append((found.at, weighted(found, idf)))
        index = build(vectors, list(range(len(keys))), np.array(known, np.int64), size)
        places = np.empty(len(keys), np.int64)
        places[np.array(index.keys, np.int64)] = np.arange(len(keys))
        fitted = calibrate(index, vectors, places, share)
        index = index._replace(keys=[keys[i] for i in index.keys])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((index, *fitted))], pa.binary())], names=["model"])

    held = (
        sample.select("key", "label", "order", "text")
        .mapInArrow(counted, T.StructType([
            sample.schema["key"], *T._parse_datatype_string("label int, order bigint, at binary, n binary, words bigint").fields,
        ]))
        .repartition(1).sortWithinPartitions("order", "label", "at", "n")
        .mapInArrow(indexed, "model binary").first()
    )
    if held is None:
        none = build([], [], np.empty(0, np.int64), size)
        return Model(vocabulary, idf, none, *calibrate(none, [], np.empty(0, np.int64), share))
    return Model(vocabulary, idf, *pickle.loads(bytes(held["model"])))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", evidence: str | None = None) -> DataFrame:
    """Add the probability of label 1, and on demand the neighbours it comes from.

    ``evidence`` names a column of (example, label, cosine), nearest first. NULL and
    empty texts, and those without a known term, have no neighbours and get the share
    of label 1 among such examples. Columns that are called so already are replaced. Texts are
    taken whole; repeated rows give repeated rows, an empty table an empty one.
    """
    if text in (out, evidence):
        raise ValueError("the score and the evidence need other columns than the text")
    docs = docs.drop(out, *([evidence] if evidence else []))
    key = T.LongType()
    near = T.ArrayType(T.StructType([
        T.StructField("example", key), T.StructField("label", T.IntegerType()), T.StructField("cosine", T.DoubleType()),
    ]))
    fields = [T.StructField(out, T.DoubleType()), *([T.StructField(evidence, near)] if evidence else [])]
    schema = T.StructType([*docs.schema.fields, *fields])
    at_text = docs.columns.index(text)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = held.value, {}
        index = model.index
        for batch in batches:
            scores, shown = [], []
            for counts in model.vocabulary.counts(batch.column(at_text)):
                mark = counts.at.tobytes() + counts.n.tobytes() + bytes(str(counts.words * len(counts.at)), "ascii")
                if mark not in seen:
                    if len(seen) > 50_000:
                        seen.clear()
                    seen[mark] = model.judge(counts)
                value, found, cosines = seen[mark]
                scores.append(value)
                if evidence:
                    shown.append([
                        {"example": index.keys[i], "label": int(index.labels[i]), "cosine": c}
                        for i, c in zip(found.tolist(), cosines.tolist(), strict=True)
                    ])
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            if evidence:
                columns.append(pa.array(shown, pa.list_(pa.struct(
                    [("example", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]
                ))))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(add, schema)

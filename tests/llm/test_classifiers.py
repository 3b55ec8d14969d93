"""Quality and toxicity scores: held-out accuracy, exact search, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from rategrid.llm import features, quality, toxicity
from rategrid.llm.queries import QUERIES
from rategrid.plans.registry import table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, score string, label int"
ODD = [(1, "", "a", 1), (2, None, "b", None), (None, "word", None, 2), (3, "long text " * 30000, "c", 0),
       (4, "twice", "d", 1), (4, "twice", "d", 1), (5, "\n \t", "", 9)]


def area(label, score):
    order = np.argsort(score, kind="stable")
    s = np.asarray(score)[order]
    first, inverse, n = np.unique(s, return_inverse=True, return_counts=True)
    rank = np.empty(len(s))
    rank[order] = (np.cumsum(n) - (n - 1) / 2)[inverse]
    y = np.asarray(label) > 0
    return (rank[y].mean() - (y.sum() + 1) / 2) / (~y).sum()


@pytest.mark.parametrize(
    ("name", "label", "threshold", "sf"),
    # Toxic documents are few: the smaller table has fewer than forty to learn from.
    [("op4_quality", "quality", 0.3, SF), ("op2_toxicity", "toxic", 0.5, "/root/testdata/sf0.1")],
)
def test_held_out(spark, name, label, threshold, sf):
    rows = QUERIES[name](spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold) for r in rows)
    truth = {r["doc_id"]: r[label] for r in table(spark, sf, "labels").collect()}
    held = [(truth[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    y, s, p = map(np.array, zip(*held, strict=True))
    assert len(held) > 50 and area(y, s) > 0.95 and (y == p).mean() > 0.95


def test_pieces_and_spans():
    texts = pa.array(["ab cd", None, "", "éa-b", "x " * 50, "y" * 90 + " z"])
    held, offsets = features.utf8(texts.slice(0))
    whole = features.Hashes(held)
    starts, ends, rows = features.word_spans(held, offsets)
    words = [bytes(held[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert list(zip(rows.tolist(), words, strict=True))[:4] == [(0, "ab"), (0, "cd"), (3, "éa"), (3, "b")]
    by_word = {}
    for w, h in zip(words, whole.spans(starts, ends).tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    found = []
    for first, part, at in features.pieces(held, offsets, 16):
        for i in range(len(at) - 1):
            found.append((first + i, bytes(part[at[i]:at[i + 1]])))
    joined = [b"".join(p for i, p in found if i == row) for row in range(len(texts))]
    assert joined == [(t or "").encode() for t in texts.to_pylist()]
    assert {w for _, p in found for w in p.split()} == {w for t in texts.to_pylist() for w in (t or "").encode().split()}


def test_scores_do_not_depend_on_neighbours(monkeypatch):
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=(1 << quality.BUCKET_BITS) + 1).astype(np.float32), 0.1)
    texts = ["One two two. three", None, "", "ÀÉ x", "The The The " * 40, "a|b " * 9]
    together = quality.logits(pa.array(texts), model)
    alone = [quality.logits(pa.array([t], pa.string()), model)[0] for t in texts]
    assert np.allclose(together, alone) and together[1] == together[2] == np.float64(0.1)
    at, share = quality.counted(pa.array(["The The The"]))[0]
    assert np.isclose(share.sum(), 1) and (1 << quality.BUCKET_BITS) in at


def test_nearest_is_exact():
    rng = np.random.default_rng(3)
    size, n = 40, 500
    idf = rng.uniform(1, 3, size)
    vectors = []
    for _ in range(n):
        at = np.sort(rng.choice(size, rng.integers(0, 6), replace=False))
        vectors.append((at, toxicity.weighted(toxicity.Counts(at, rng.integers(1, 3, len(at)), 90), idf)))
    index = toxicity.build(vectors, list(range(n)), rng.integers(0, 2, n), size)
    dense = np.zeros((n, size))
    for place, i in enumerate(index.keys):
        dense[place, vectors[i][0]] = vectors[i][1]
    for at, w in vectors[:200]:
        found, scores = toxicity.nearest(index, at, w)
        q = np.zeros(size)
        q[at] = w
        every = dense @ q
        best = np.lexsort((np.arange(n), -np.round(every, 12)))[:toxicity.NEIGHBOURS]
        best = best[every[best] > 0]
        assert np.allclose(scores, every[best]) and found.tolist() == best.tolist()


def test_isotonic():
    x, v = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert x.tolist() == [0.1, 0.3, 0.4] and v.tolist() == [0, 0.5, 1]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (None, 1), (5, None)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model, out="p").collect()
    assert len(rows) == len(ODD) and all(0 <= r["p"] <= 1 for r in rows)
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r["p"] >= 0.3 for r in rows)
    none = spark.createDataFrame([], SCHEMA)
    assert quality.score(none, quality.train(none, labels), out="p").count() == 0
    assert quality.train(docs, labels.filter("false")).bias == 0
    toxic = labels.withColumnRenamed("quality", "toxic")
    model = toxicity.train(docs, toxic)
    rows = toxicity.score(docs, model, out="p", evidence="near").collect()
    assert len(rows) == len(ODD) and all(0 <= r["p"] <= 1 for r in rows)
    assert toxicity.score(none, toxicity.train(none, toxic), out="p").count() == 0


def test_evidence(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    shown = 0
    for r in toxicity.score(docs, model, out="p", evidence="near").collect():
        cosines = [n["cosine"] for n in r["near"]]
        assert cosines == sorted(cosines, reverse=True) and len(cosines) <= toxicity.NEIGHBOURS
        assert all(truth[n["example"]] == n["label"] for n in r["near"])
        shown += bool(cosines)
    assert shown > 20

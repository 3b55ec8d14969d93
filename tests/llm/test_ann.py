"""Learned partitions: recall against brute force, exact scores, odd vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rategrid.llm import ann
from rategrid.llm.queries import QUERIES
from rategrid.plans.registry import table

SCHEMA = "vec_id bigint, embedding array<float>, score int"


def brute(rows, asked, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero([asked(j) for j in ids]):
        s = (x * x[i]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def check(found, wanted, k=20):
    by = {}
    for r in found:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(wanted)
    hit = total = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == min(k, len(wanted[q]))
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        true = dict(wanted[q])
        hit += sum(r["vec_id"] in true for r in rows)
        total += len(true)
        for r in rows:
            if r["vec_id"] in true:
                assert abs(true[r["vec_id"]] - r["score"]) < 1e-12
    return hit / total


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_query(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, folder, "embeddings").collect()]
    recall = check(QUERIES["op10_ann"](spark, folder).collect(), brute(rows, lambda i: i % 20 == 0))
    assert recall >= 0.9


def test_few_visits_on_clusters(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16)) * 4
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = ann.fit(x.astype(float), 10)
    assert model.parts == 15 and model.visits <= 8
    monkeypatch.setattr(ann, "ROWS", 100)
    monkeypatch.setattr(ann, "QUERIES", 30)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    found = ann.search(frame, F.col("vec_id") % 40 == 0, k=10).collect()
    assert check(found, brute(list(enumerate(x)), lambda i: i % 40 == 0, 10), 10) >= 0.9


def test_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(1000, 8))
    sizes = np.bincount(ann.balanced(x, ann.neighbours(x, 10), 7), minlength=7)
    assert sizes.sum() == 1000 and sizes.max() <= 143 + 8


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20 * i, [1.0, float(i % 3)], 0) for i in range(4)] + [(i, [1.0, 1.0], 1) for i in range(1, 100) if i % 20]
    rows += [(1001, None, 1), (1002, [0.0, 0.0], 1), (1003, [nan, 1.0], 1), (1004, [None, 1.0], 1), (1005, [inf, 1.0], 1),
             (None, [9.0, 9.0], 1), (1006, [9.0], 1), (1007, [], 1), (1060, [nan, 1.0], 1), (20, [1.0, 1.0], 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = ann.search(frame, F.col("vec_id") % 20 == 0).collect()
    good = {i: v for i, v, _ in rows[:-10]}
    assert check(found, brute(sorted(good.items()), lambda i: i % 20 == 0)) == 1.0
    wanted = brute(sorted(good.items()), lambda i: i % 20 == 0)
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for i, _ in v] for q, v in wanted.items()}
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (3, [0.5, 0.5], 1)], SCHEMA)
    assert [tuple(r) for r in ann.search(few, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 3, 0.5)]
    assert ann.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0

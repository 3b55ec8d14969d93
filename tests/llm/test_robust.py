"""Clashing columns, shuffled input, common vectors, many texts of a language, no shared folder."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rategrid.llm import ann, bpe, language, lines, quality, simhash, store, toxicity
from rategrid.plans.registry import table
from tests.llm.test_ann import brute, check

SF = "/root/testdata/sf0.001"


def test_columns_that_are_called_so_are_replaced(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", F.lit("old").alias("score"), F.lit(1).alias("fp"))
    labels = table(spark, SF, "labels")
    for module in (quality, toxicity):
        found = module.score(docs, module.train(docs, labels))
        assert found.columns == ["doc_id", "text", "fp", "score"]
        assert found.filter("score between 0 and 1").count() == docs.count()
        with pytest.raises(ValueError, match="another column|other columns"):
            module.score(docs, None, out="text")
    model = toxicity.train(docs, labels)
    assert toxicity.score(docs, model, evidence="fp").columns == ["doc_id", "text", "score", "fp"]
    printed = simhash.with_fingerprint(docs)
    assert printed.columns == ["doc_id", "text", "score", "fp"] and printed.filter("fp = 1").count() == 0
    few = spark.createDataFrame([(1, "a b\na b", 9, "x"), (2, "c", 9, "y")], "doc_id bigint, text string, n int, gone string")
    done = lines.drop_repeated_lines(few, counts=("n", "gone"))
    assert done.columns == ["doc_id", "text", "n", "gone"]
    assert sorted(map(tuple, done.collect())) == [(1, "a b", 2, 1), (2, "c", 1, 0)]


def test_bpe_of_shuffled_texts(spark, tmp_path):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    plain = {r["doc_id"]: (bytes(r["ids"]), r["decoded"]) for r in bpe.encode_and_decode(docs).collect()}
    shuffled = docs.repartition(7)
    assert store.steady(docs, "x") is docs and store.steady(shuffled, "x") is not shuffled
    mixed = {r["doc_id"]: (bytes(r["ids"]), r["decoded"]) for r in bpe.encode_and_decode(shuffled).collect()}
    assert mixed == plain


class Cluster:
    class sparkContext:  # noqa: N801
        master = "yarn"

    class conf:  # noqa: N801
        @staticmethod
        def get(name, default=None):
            return default


def test_no_folder_of_ones_own_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.folder(Cluster)


def test_a_vector_that_most_rows_share(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    common = rng.normal(size=16).astype(np.float32)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int").unionByName(
        spark.range(1500, 200_000).select(
            F.col("id").alias("vec_id"), F.array(*[F.lit(float(c)).cast("float") for c in common]).alias("embedding"), F.lit(0).alias("score")
        )
    )
    # Queries among the distinct vectors; copies count as so many rows each.
    asked = lambda i: i < 1500 and i % 20 == 0
    found = ann.search(frame, (F.col("vec_id") < 1500) & (F.col("vec_id") % 20 == 0), most=1024).collect()
    wanted = brute([*enumerate(x), *((1500 + i, common) for i in range(21))], asked)
    assert check(found, wanted) >= 0.9


def test_queries_in_thin_parts_get_all_rows(spark, monkeypatch):
    # Parts of some ten rows, of which a query visits few: it still gets twenty.
    monkeypatch.setattr(ann, "PART", 10)
    monkeypatch.setattr(ann, "LINKS", 5)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 8)) * 5
    x = (centres[np.repeat(np.arange(30), 10)] + rng.normal(size=(300, 8)) * 0.1).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>, score int")
    found = ann.search(frame, F.col("vec_id") % 20 == 0, recall=0.5).collect()
    per = {}
    for r in found:
        per[r["query_id"]] = per.get(r["query_id"], 0) + 1
    assert per == {i: 20 for i in range(0, 300, 20)}


def test_smallest_hashes_of_each_language(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "en").when(F.col("id") % 100 == 1, "fr").otherwise("de").alias("lang"),
        # A third of the rows of a language share their hash.
        F.xxhash64(F.when(F.col("id") % 9 == 0, 1).otherwise(F.col("id"))).alias("order"),
    )
    few = language.lowest(rows, 50)
    got = {}
    for r in few.collect():
        got.setdefault(r["lang"], []).append(r["order"])
    every = {}
    for r in rows.distinct().collect():
        every.setdefault(r["lang"], []).append(r["order"])
    for x, orders in every.items():
        assert sorted(got[x])[:50] == sorted(orders)[:50] and len(set(got[x])) == len(got[x])
    assert len(got["de"]) < 1000 and len(got["fr"]) < 1000

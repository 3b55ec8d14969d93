"""The pipeline, stage by stage, each against a plain version on its own input."""

from __future__ import annotations

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rategrid.llm import language, quality
from rategrid.llm.tokens import VOCABULARY
from rategrid.plans.registry import table
from tests.llm.test_lines import brute
from tests.llm.test_simhash import groups, plain_fingerprint
from tests.llm.test_tokens import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input, output) of every stage, as the next one reads it."""
    docs, seen = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        seen[name] = (docs, out)
        docs = out
    return seen


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "lines", "near_duplicates", "packing"]


def test_columns_stay(stages):
    for name, (docs, out) in stages.items():
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_quality(spark, stages):
    docs, out = stages["quality"]
    labels = table(spark, SF, "labels")
    scored = quality.score(docs, quality.train(docs, labels), out="p").filter("p >= 0.3").drop("p")
    assert rows(out) == rows(scored)
    kept = {r["doc_id"] for r in out.collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(d in kept for d, q in truth.items() if q)
    assert sum(d in kept for d, q in truth.items() if not q) <= 2


def test_language(spark, stages):
    docs, out = stages["language"]
    found = language.identify(docs, language.train(docs), "doc_id", "text", declared="lang", host="source")
    known = {r["doc_id"] for r in found.collect() if r["lang"] != language.UNKNOWN and r["confidence"] >= language.SURE}
    assert rows(out) == sorted((tuple(r) for r in docs.collect() if r["doc_id"] in known), key=str)
    assert out.count() > 0.98 * docs.count()


def test_lines(stages):
    docs, out = stages["lines"]
    wanted = brute([(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()])
    assert {r["doc_id"]: r["text"] for r in out.collect()} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_near_duplicates(stages):
    docs, out = stages["near_duplicates"]
    every = {r["doc_id"]: tuple(r) for r in docs.collect()}
    found = groups({d: plain_fingerprint(r[1] or "") for d, r in every.items()})
    assert rows(out) == sorted((r for d, r in every.items() if found[d] == d), key=str)


def test_packing(stages):
    docs, out = stages["packing"]
    library = Tokenizer.from_file(VOCABULARY)
    ids = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    filled = check_packing(out.collect(), ids)
    assert sum(2048 - n for n in filled if n & (n - 1)) < 0.05 * sum(filled)


def test_run_is_its_stages(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages["packing"][1])


def test_empty_and_odd_documents(spark):
    docs = table(spark, SF, "documents")
    odd = docs.sparkSession.createDataFrame(
        [(None, None, None, None, None, "x"), (-1, "", "en", "src0", 0, "y"), (-1, "", "en", "src0", 0, "y"),
         (-2, "жзйкл мнпрс туфхц чшщьы " * 30, "en", "src0", 720, None)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")
    more = docs.unionByName(odd, allowMissingColumns=True)
    for given in (more, more.limit(0)):
        now = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == more.columns, name
        kept = [r["doc_id"] for r in now.collect()]
        assert -2 not in kept and kept.count(-1) <= 1 and len(kept) <= given.count()
        corpus_pipeline.STAGES[-1][1](spark, now, SF).count()

"""Language by fused evidence."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rategrid.llm import language
from rategrid.llm.features import held_out
from rategrid.llm.queries import QUERIES, page_evidence
from rategrid.plans.registry import table

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id bigint, text string, lang string, source string, host string"


def test_held_out(spark):
    docs = table(spark, SF, "documents")
    model = language.train(docs.filter(~held_out(F.col("doc_id"))))
    found = language.identify(docs.filter(held_out(F.col("doc_id"))), model, "doc_id", "text").collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in found)
    right = sum(r["lang"] == truth[r["doc_id"]] for r in found)
    assert len(found) > 150 and right / len(found) > 0.97


def test_query(spark):
    rows = {r["page_id"]: r for r in QUERIES["op6_language"](spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    assert set(rows) == {p["page_id"] for p in pages} and len(rows) == len(pages)
    declared = {r["page_id"]: r["declared"] for r in page_evidence(table(spark, SF, "pages")).collect()}
    agree = sum(rows[p]["lang"] == d for p, d in declared.items() if d)
    assert agree / sum(map(bool, declared.values())) > 0.95
    assert all(0 < r["confidence"] <= 1 for r in rows.values())


def model_of(spark):
    return language.train(table(spark, "/root/testdata/sf0.1", "documents").filter("lang in ('en', 'de')"))


def test_evidence_besides_text(spark):
    model = model_of(spark)
    rows = [(i, "the thing that was on the other " * 4, "en", "a", "x.org") for i in range(20)]
    rows += [(20 + i, "der die und nicht von der mit schkeit " * 4, "de", "b", "y.org") for i in range(20)]
    rows += [(50, "", "en", "a", "x.org"), (51, None, "de", "b", "y.org"), (52, "zq", None, None, "y.org"), (53, "", None, None, None)]
    rows += [(60, "жзйкл мнпрс туфхц чшщ " * 9, "en", "a", "x.org")]
    frame = spark.createDataFrame([*rows, rows[0]], SCHEMA)
    found = language.identify(frame, model, "page_id", "text", declared="lang", host="host")
    at = {r["page_id"]: r for r in found.collect()}
    assert found.count() == len(rows) + 1
    assert (at[50]["lang"], at[51]["lang"], at[52]["lang"]) == ("en", "de", "de")
    assert at[50]["text_lang"] == language.UNKNOWN and at[60]["lang"] == at[60]["text_lang"] == language.UNKNOWN
    assert all(at[i]["lang"] == ("en" if i < 20 else "de") for i in range(40))
    alone = language.identify(frame, model, "page_id", "text").collect()
    assert {r["page_id"]: r["lang"] for r in alone}[3] == "en"


def test_keep_known(spark):
    model = model_of(spark)
    rows = [(1, "the thing that was and this other", "en", "s", "q"), (2, "жзйкл мнпрс туфхц " * 9, None, "s", "q"), (None, "der und die nicht", "de", None, "q"),
            (1, "the thing that was and this other", "en", "s", "q"), (4, "the thing " * 40000, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = language.keep_known(docs, model)
    assert kept.schema == docs.schema
    assert sorted(r["page_id"] or 0 for r in kept.collect()) == [0, 1, 1, 4]
    none = spark.createDataFrame([], SCHEMA)
    empty = language.train(none)
    assert empty.languages == [language.UNKNOWN] and language.keep_known(none, empty).count() == 0
    assert language.identify(none, model, "page_id", "text").count() == 0


def test_grams_stay_in_their_text():
    texts = pa.array(["abcd", "", None, "ef", "ghi", "j"])
    counts = {}
    for first, found, ends in language.grams(texts):
        for i in range(len(ends) - 1):
            counts[first + i] = ends[i + 1] - ends[i]
    assert [counts[i] for i in range(6)] == [2, 0, 0, 0, 1, 0]


def test_every_labelled_language_is_learnt(spark):
    rows = []
    for i in range(300):
        word = "".join(chr(0x4E00 + 7 * i + j) for j in range(7))
        # A few languages have more texts than the others.
        rows += [(len(rows) + j, f"{word} " * (20 + j), f"l{i:03}", "s", "h") for j in range(1 + i % 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.train(docs)
    assert model.languages == [*(f"l{i:03}" for i in range(300)), language.UNKNOWN]
    kept = {r["page_id"] for r in language.keep_known(docs, model).collect()}
    assert kept == {r[0] for r in rows}
    found = language.identify(docs, model, "page_id", "text").collect()
    wrong = [r for r in found if r["text_lang"] != dict((x[0], x[2]) for x in rows)[r["page_id"]]]
    assert not wrong


def test_model_is_that_of_plain_counts(spark):
    texts = [(1, "abcd abc", "x", "", ""), (2, "abc", "x", "", ""), (3, "abc", "x", "", ""), (4, "qrs", "y", "", "")]
    model = language.train(spark.createDataFrame(texts, SCHEMA))
    counts = np.zeros((2, 1 << language.BITS))
    for row, part in ((0, ["abcd abc", "abc"]), (1, ["qrs"])):
        for _, found, _ in language.grams(pa.array(part)):
            np.add.at(counts[row], found, 1)
    own = (counts + language.ADD) / (counts.sum(1, keepdims=True) + language.ADD * (1 << language.BITS))
    assert np.allclose(model.log[:2], np.log((1 - language.MIXED) * own + language.MIXED / (1 << language.BITS)))


def test_distinct_values_are_counted_exactly(spark):
    rows = spark.range(30000).selectExpr("if(id % 3 = 0, NULL, cast(id % 9973 as string)) as declared")
    assert language.distinct_values(rows, "declared") == len({i % 9973 for i in range(30000) if i % 3})
    assert language.distinct_values(rows.limit(0), "declared") == 0

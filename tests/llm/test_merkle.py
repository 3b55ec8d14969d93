"""Merkle fingerprints: a plain tree, edited texts, neighbours in order of keys."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from rategrid.llm import merkle
from rategrid.llm.queries import ORACLES, QUERIES
from rategrid.plans.registry import table
from tests.check import duck

SF = "/root/testdata/sf0.001"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain_runs(paragraph):
    spaced = " " in paragraph
    parts, size, gap = (paragraph.split(" "), 4, " ") if spaced else (list(paragraph), 16, "")
    ends = [((ord(w[0]) if w else 0) + (len(w) if spaced else 0)) % size == 0 for w in parts]
    runs = [[]]
    for i, (word, end) in enumerate(zip(parts, ends, strict=True)):
        runs[-1].append(word)
        if end and i + 1 < len(parts):
            runs.append([])
    cut = [[run] if len(run) <= 64 else [run[i:i + size] for i in range(0, len(run), size)] for run in runs]
    return [gap.join(run) for some in cut for run in some]


def plain_tree(text):
    sections = []
    for section in text.split("\n\n"):
        paragraphs = section.split("\n")
        hashes = [md5(p) for p in paragraphs]
        below = [
            h[:8] + "." + ".".join(md5(r)[:8] for r in plain_runs(p)) for h, p in zip(hashes, paragraphs, strict=True)
        ]
        sections.append((md5("".join(hashes)), ",".join(below)))
    return md5("".join(h for h, _ in sections)) + ":" + ";".join(f"{h[:8]}={b}" for h, b in sections)


def plain_likeness(a, b):
    if a[:32] == b[:32]:
        return 1.0
    x, y = ([r for s in t.split(":")[1].split(";") for p in s.split("=")[1].split(",") for r in p.split(".")[1:]] for t in (a, b))
    shared = 2 * len(set(x) & set(y)) / (len(set(x)) + len(set(y)))
    placed = sum(p == q for p, q in zip(x, y, strict=False)) / max(len(x), len(y))
    return min(max(shared, placed), 0.9999)


def plain_rows(docs):
    """By key, one document a key."""
    docs = sorted((k, t or "") for k, t in docs)
    out = {}
    for i, (key, text) in enumerate(docs):
        ahead = docs[(i + 1) % len(docs)][1]
        n = len(text) // 4
        edited = text[:len(text) - n] + ahead[:n]
        trees = plain_tree(text), plain_tree(edited), plain_tree(ahead)
        out[key] = (len(text), edited, trees[0], trees[1], plain_likeness(*trees[:2]), plain_likeness(trees[0], trees[2]))
    return out


def rounded(rows):
    return {k: (*v[:4], round(v[4], 9), round(v[5], 9)) for k, v in rows.items()}


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    wanted = plain_rows(docs)
    found = {
        r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"])
        for r in QUERIES["op8_merkle"](spark, SF).collect()
    }
    for v in wanted.values():
        assert 0 <= v[4] <= 1
    assert rounded(found) == rounded({k: (v[0], hashlib.sha256(v[1].encode()).hexdigest(), *v[2:]) for k, v in wanted.items()})


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    asked = duck(folder).execute(ORACLES["op8_merkle"])
    names = [c[0] for c in asked.description]
    found = QUERIES["op8_merkle"](spark, folder)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(asked.fetchall())


def test_odd_rows(spark):
    rows = [(5, "", 1), (1, None, 2), (9, "é🙂x " * 9 + "\n\n\nq", None), (7, " a  b\n\n", 4), (3, "w " * 40000, 1)]
    schema = "doc_id bigint, text string, fingerprint int"
    docs = spark.createDataFrame(rows, schema)
    found = {r["doc_id"]: tuple(r)[1:] for r in merkle.compare_with_next(docs).collect()}
    assert rounded(found) == rounded(plain_rows([r[:2] for r in rows]))
    more = docs.unionByName(spark.createDataFrame([(7, " a  b\n\n", 4), (7, "z", 1), (None, "no key at all", 1)], schema))
    seen = merkle.compare_with_next(more).collect()
    assert len(seen) == 8
    assert {r["edited"] for r in seen if r["doc_id"] == 5} == {""}
    (alone,) = [r for r in seen if r["doc_id"] is None]
    assert alone["edited"] == "no key at " and alone["near_next"] == 0
    assert merkle.compare_with_next(spark.createDataFrame([], schema)).count() == 0
    (one,) = merkle.compare_with_next(spark.createDataFrame([(1, "abcdefgh", 1)], schema)).collect()
    assert one["edited"] == "abcdefab" and one["near_next"] == 1.0


def test_differing(spark):
    a, b = "a b\nc d\n\ne f\ng h", "a b\nc x\n\ne f\ng h\ni"
    frame = spark.createDataFrame([(a, b), (a, a), (a, "z")], "a string, b string")
    found = frame.select(merkle.differing(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))).alias("d")).collect()
    assert [[tuple(x) for x in r["d"]] for r in found] == [[(1, 2), (2, 3)], [], [(1, 1), (1, 2), (2, 1), (2, 2)]]


def test_no_python_on_the_way(spark):
    plan = QUERIES["op8_merkle"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_texts_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        done = QUERIES["op8_merkle"](spark, SF)
        done.collect()
        plan = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan and plan.count("FileScan parquet [doc_id") == 1


def near(spark, one, other):
    row = spark.createDataFrame([(one, other)], "a string, b string").select(
        merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b")
    ).select(merkle.likeness(F.col("a"), F.col("b"), merkle.runs_of(F.col("a")), merkle.runs_of(F.col("b"))).alias("x")).first()
    return row["x"]


def test_a_word_put_in_changes_little(spark):
    words = [f"w{i * 37 % 101}x{i}" for i in range(200)]
    text = " ".join(words)
    assert near(spark, text, "new " + text) > 0.9
    assert near(spark, text, " ".join(words[:90] + ["new"] + words[90:])) > 0.9
    assert near(spark, text, " ".join(f"v{i * 53 % 97}" for i in range(200))) < 0.1


def test_texts_without_blanks(spark):
    signs = "".join(chr(0x4E00 + i * i * 31 % 5000) for i in range(400))
    other = "".join(chr(0x4E00 + i * i * 17 % 4999 + 1) for i in range(400))
    assert near(spark, signs, signs[:300] + other[:100]) > 0.5
    assert near(spark, signs, "\u4e00" + signs) > 0.9
    assert near(spark, signs, other) < 0.1


def test_one_word_over_and_over(spark):
    text = "the " * 400
    assert near(spark, text, text[:1200] + "other words " * 30) > 0.5

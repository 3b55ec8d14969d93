"""SimHash near duplicates against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from rategrid.llm import hamming
from rategrid.llm.graph import components
from rategrid.llm.queries import QUERIES
from rategrid.llm.simhash import fingerprint, keep_one, linked, near_duplicates
from rategrid.plans.registry import table

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text: str) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict, bits: int = 4) -> dict:
    """Smallest key reachable, by all pairs."""
    keys = list(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", [
    "", "  \n", "one", "A b C", "x y z w v", "É é a b c d e f", "a a a a a a a", "w " * 700,
])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_blocks():
    words = " ".join(str(i * i) for i in range(500))
    assert fingerprint(words, block=7) == fingerprint(words) == plain_fingerprint(words)


def test_links_against_all_pairs(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:40]:
        for n in range(rng.randint(0, 7)):
            for b in rng.sample(range(64), n):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    wanted = groups({s[0]: p for s, p in zip(signed, prints, strict=True)})
    for cell in (hamming.CELL, 4):
        frame = spark.createDataFrame(signed, "fp bigint")
        found = {r["fp"]: r["group"] for r in linked(frame, cell=cell).collect()}
        assert {k: found.get(k, k) for k in wanted} == wanted


def test_forest_spans():
    prints = np.array([0, 1, 3, 7, 1 << 40, (1 << 40) | 1, 1 << 63], np.uint64)
    a, b = hamming.forest(prints, 1)
    assert len(a) == 6 and all((int(prints[x]) ^ int(prints[y])).bit_count() <= 1 for x, y in zip(a, b, strict=True))


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 3), (5, 5), (7, 8), (8, 7), (None, 1), (20, 21), (21, 22), (22, 23), (23, 24)]
    found = components(spark.createDataFrame(pairs, "x int, y int")).collect()
    assert {r["node"]: r["component"] for r in found} == {
        1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20,
    } and len(found) == 11
    assert components(spark.createDataFrame([], "x int, y int")).count() == 0


def test_query_against_all_pairs(spark):
    docs = table(spark, SF, "documents").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"] or "") for r in docs}
    found = {r["doc_id"]: r for r in QUERIES["op9_simhash"](spark, SF).collect()}
    assert {k: int(r["fingerprint"], 16) for k, r in found.items()} == prints
    assert all(len(r["fingerprint"]) == 16 for r in found.values())
    assert {k: r["component_id"] for k, r in found.items()} == groups(prints)


def test_odd_rows(spark):
    rows = [(3, None, 1), (1, "", 2), (None, "a b c d e", 3), (2, "a b c d e", 4), (2, "a b c d e", 5),
            (7, "q " * 5000, None), (8, "other words that stand alone here", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    found = sorted((r["doc_id"] or 0, r["component_id"]) for r in near_duplicates(docs).collect())
    assert found == [(0, 2), (1, 1), (2, 2), (2, 2), (3, 1), (7, 7), (8, 8)]
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 7, 8]
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(none).count() == 0 and keep_one(none).count() == 0


def test_keep_one_of_keys_with_several_texts(spark):
    one, other = (" ".join(f"{w}{i * i}" for i in range(60)) for w in "ab")
    for rows in ([(5, one), (5, other)], [(5, other), (5, one), (5, one)]):
        kept = keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert sorted(tuple(r) for r in kept) == [(5, one), (5, other)]
    for a, b in ((one, other), (other, one)):
        rows = [(3, a), (5, a), (5, b), (None, a), (7, None), (7, "")]
        kept = keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert {tuple(r) for r in kept} >= {(3, a), (5, b), (None, a)} and len(kept) == 4

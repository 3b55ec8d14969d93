"""Phrases against plain counting, with small summaries and without early selection."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rategrid.llm import collocations as c
from rategrid.llm.queries import ORACLES, QUERIES
from tests.check import duck

SCHEMA = "doc_id bigint, text string, lang string, score int"


def plain(rows, least, longest, top):
    counts, totals = {}, Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, all_of in counts.items():
        some = {p: a for p, a in all_of.items() if a >= least}
        ranked = []
        for p, a in some.items():
            if len(p) == 1 or any(
                len(q) > len(p) and some[q] >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q in some
            ):
                continue
            cuts = [(1000 * a * totals[lang] // (some[p[:k]] * some[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), a, some[p[:k]], some[p[k:]], totals[lang], score))
        for rank, r in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, r[2].decode(), *r[3:]))
    return sorted(out)


def texts(rnd, n):
    words = ["a", "b", "Cc", "d", "é", "\x01", "zu z"]
    phrases = ["New York City", "a b a b", "x y", "É é", "one two three four five six"]
    out = []
    for i in range(n):
        part = [rnd.choice(phrases) if rnd.random() < 0.3 else rnd.choice(words) for _ in range(rnd.randint(0, 30))]
        text = "".join(p + rnd.choice([" ", " ", " ", "\t", ". ", "\n", "  ", "?"]) for p in part)
        out.append((i, text, rnd.choice(["en", "en", "de", None, "und", ""]), 1))
    return [*out, (None, None, "en", 1), (7, "", None, 1), (7, "\n.?", "xx", 1)]


@pytest.mark.parametrize("most", [c.HELD, 0])
@pytest.mark.parametrize(("least", "longest", "top"), [(10, 5, 2000), (4, 3, 7), (25, 2, 3)])
def test_against_counting(spark, monkeypatch, most, least, longest, top):
    monkeypatch.setattr(c, "CHUNK", 300)
    monkeypatch.setattr(c, "TALLY", 200)
    rows = texts(random.Random(least), 150)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = c.collocations(frame, least=least, longest=longest, top=top, most=most)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain(rows, least, longest, top)


def test_summary_keeps_what_is_frequent():
    rng = np.random.default_rng(0)
    for least in (20, 50):
        stream = np.concatenate([rng.integers(0, 5000, 20_000), np.repeat(np.arange(9000, 9010), least)])
        rng.shuffle(stream)
        summary = c.Summary(len(stream) // least + 1)
        for part in np.array_split(stream, 40):
            h, n = np.unique(part, return_counts=True)
            summary.add(h, n)
            summary.merge()
            assert len(summary.hashes) <= summary.capacity
        h, n = np.unique(stream, return_counts=True)
        assert set(h[n >= least]) <= set(summary.frequent(least))
        assert summary.short < least
        assert len(summary.frequent(least)) <= summary.capacity


def test_phrases_under_one_hash_are_counted_apart(spark, monkeypatch):
    monkeypatch.setattr(c, "_mixed", lambda h: h & np.uint64(3))
    rows = texts(random.Random(1), 60)
    found = c.collocations(spark.createDataFrame(rows, SCHEMA), least=8)
    assert sorted(map(tuple, found.collect())) == plain(rows, 8, 5, 2000)


def test_equal_scores_at_the_end_of_the_list(spark):
    # Forty pairs alike in everything but their words.
    rows = [(i, f"p{i % 40:02} q{i % 40:02}.", "en", 0) for i in range(400)]
    found = c.collocations(spark.createDataFrame(rows, SCHEMA), least=10, top=7).collect()
    assert [r["phrase"] for r in sorted(found, key=lambda r: r["rank"])] == [f"p{i:02} q{i:02}" for i in range(7)]


def test_large_counts_stay_exact(spark):
    # Products beyond 64 bits, by the expression the operator uses.
    value = spark.sql(
        "SELECT (cast(1000 as decimal(38,0)) * a * total) div (cast(l as decimal(38,0)) * cast(r as decimal(19,0))) AS s "
        "FROM VALUES (7000000001L, 9000000000007L, 8000000003L, 7000000001L) AS t(a, total, l, r)"
    ).first()["s"]
    assert value == 1000 * 7000000001 * 9000000000007 // (8000000003 * 7000000001)


def test_nothing(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert c.collocations(spark.createDataFrame([(1, None, None, 1), (2, "a b", "en", 1)], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="two words"):
        c.collocations(spark.createDataFrame([], SCHEMA), longest=1)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    wanted = duck(sf).execute(ORACLES["op12_collocations"])
    names = [d[0] for d in wanted.description]
    rows = [tuple(r) for r in QUERIES["op12_collocations"](spark, sf).select(*names).collect()]
    assert rows and sorted(rows) == sorted(wanted.fetchall())


def test_counts_are_dealt_a_row_for_each_partition(monkeypatch):
    """However many phrases are frequent, a task's counts are a row for each hash partition."""
    monkeypatch.setattr(c, "CHUNK", 3000)
    for words in (20, 2000):
        text = ". ".join(f"p{i} q{i}" for i in range(words) for _ in range(3))
        batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
        wanted = Counter(w for i in range(words) for w in (f"p{i}", f"q{i}", f"p{i} q{i}") for _ in range(3))
        hashes = np.concatenate([h for chunk, _ in c.chunks(iter([batch])) for _, _, h in chunk.grams(2)])
        held = c.Held(np.unique(hashes))
        rows = pa.Table.from_batches(c.dealt(iter([batch, batch]), 8, 2, held))
        assert rows.num_rows <= 8 and sorted(rows["part"].to_pylist()) == rows["part"].to_pylist()
        found = pa.Table.from_batches(c.added(iter(rows.to_batches()), 6)).to_pylist()
        assert {r["phrase"]: r["n"] for r in found if r["size"]} == {w: 2 * n for w, n in wanted.items()}
        assert [r["n"] for r in found if not r["size"]] == [12 * words]


def test_counts_added_up_in_parts(monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 300)
    rows = texts(random.Random(3), 150)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows], "text": [r[1] or "" for r in rows]})
    hashes = np.concatenate([h for chunk, _ in c.chunks(iter([batch])) for _, _, h in chunk.grams(5)])
    held = c.Held(np.unique(hashes))
    found = []
    for summed in (c.SUMMED, 20_000, 2000, 1):
        monkeypatch.setattr(c, "SUMMED", summed)
        dealt = pa.Table.from_batches(c.dealt(iter([batch, batch]), 7, 5, held)).sort_by("part").combine_chunks()
        found.append(sorted(pa.Table.from_batches(c.added(iter(dealt.to_batches()), 6)).to_pylist(), key=str))
    assert len(found[0]) > 100 and all(f == found[0] for f in found)

"""Runs of words against a search period by period."""

from __future__ import annotations

import random

import pytest

from rategrid.llm.periodic import collapsed, find_runs, runs_of
from rategrid.llm.queries import ORACLES, QUERIES
from tests.check import duck

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=24, times=3):
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted([(s, n, q) for (s, n), q in out.items()], key=lambda r: (r[0], r[2]))


def made(rnd):
    words = []
    while len(words) < rnd.randint(0, 150):
        kinds = rnd.choice([1, 2, 3, 50])
        base = [b"%d" % rnd.randrange(kinds) for _ in range(rnd.choice([1, 1, 2, 3, 5, 8, 13, 30]))]
        part = base * rnd.choice([1, 2, 3, 4, 9])
        part = part[:len(part) - rnd.randrange(len(base))]
        if rnd.random() < 0.3:
            part[rnd.randrange(len(part))] = b"x"
        words += part
    return words


@pytest.mark.parametrize(("least", "times"), [(24, 3), (8, 4), (5, 3)])
def test_against_every_period(least, times):
    rnd = random.Random(least)
    for _ in range(300):
        texts = [made(rnd) for _ in range(rnd.randint(1, 6))]
        assert runs_of(texts, least, times) == [plain_runs(t, least, times) for t in texts]


def test_long_texts_of_few_words():
    assert runs_of([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]
    # One long period, and a phrase of 17 words behind 3,000 different words: no run.
    period = [b"%d" % i for i in range(9000)]
    assert runs_of([period * 3 + [b"end"]]) == [[(0, 27_000, 9000)]]
    assert runs_of([[w for i in range(3000) for w in (b"%d" % i, *[b"p%d" % j for j in range(17)])]]) == [[]]
    # Runs in runs: thirty a, then b, four times.
    assert runs_of([([b"a"] * 30 + [b"b"]) * 4]) == [[(0, 30, 1), (0, 124, 31), (31, 30, 1), (62, 30, 1), (93, 30, 1)]]


def test_two_periods_are_refused():
    with pytest.raises(ValueError, match="three periods"):
        runs_of([[b"a"]], times=2)


def test_rows(spark):
    run = "x y\tz \n" * 9
    rows = [(1, run, "k"), (1, run, "k"), (2, None, "k"), (3, "", "k"), (None, " \n ", "k"), (5, "a b c", "k")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    found = find_runs(frame).collect()
    assert sorted(
        [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found], key=repr
    ) == sorted([
        (1, 27, [(0, 27, 3)], "x y z"), (1, 27, [(0, 27, 3)], "x y z"), (2, 0, [], ""), (3, 0, [], ""), (None, 0, [], ""),
        (5, 2, [], "a b c"),
    ], key=repr)
    assert find_runs(frame.limit(0)).count() == 0
    plan = find_runs(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_texts_of_any_length_in_one_batch(spark, monkeypatch):
    rnd = random.Random(3)
    texts = [b" ".join(made(rnd)).decode() for _ in range(40)] + ["a b " * 5000, "", "z"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    found = {r["doc_id"]: r for r in find_runs(frame).collect()}
    for i, t in enumerate(texts):
        words = t.encode().split()
        runs = plain_runs(words) if len(words) < 1000 else [(0, 10_000, 2)]
        assert [tuple(x) for x in found[i]["runs"]] == runs
        drop = {j for s, n, q in runs for j in range(s + q, s + n)}
        assert found[i]["collapsed"] == " ".join(w.decode() for j, w in enumerate(words) if j not in drop)
        assert collapsed(words, runs).decode() == found[i]["collapsed"]


def test_query(spark):
    found = QUERIES["op11_runs"](spark, SF)
    wanted = duck(SF).execute(ORACLES["op11_runs"])
    names = [d[0] for d in wanted.description]
    rows = [tuple(r) for r in found.select(*names).collect()]
    assert sorted(rows, key=repr) == sorted(wanted.fetchall(), key=repr)
    assert sum(r[1] > 0 for r in rows) >= 10

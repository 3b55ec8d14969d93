"""Near-duplicate vectors against all pairs in double precision."""

from __future__ import annotations

import numpy as np
import pytest

from rategrid.llm import vector_dedup as d
from rategrid.llm.queries import ORACLES, QUERIES
from tests.check import duck

SCHEMA = "vec_id bigint, embedding array<float>, n int, component string"


def plain(ids, x, least=0.95):
    y = np.asarray(x, np.float64)
    y = y / np.sqrt((y * y).sum(1, keepdims=True))
    near = y @ y.T >= least
    np.fill_diagonal(near, False)
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], len(ids)).min(1, initial=len(ids)))
        low = low[low]
        if (low == root).all():
            break
        root = low
    out = {}
    for r in np.unique(root):
        group = np.flatnonzero(root == r)
        for i in group:
            out[int(ids[i])] = (int(near[i].sum()), int(ids[group].min()))
    return out


def rows_of(found):
    rows = found.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}
    assert len(out) == len(rows)
    return out


def clouds(rng, n, width, dims):
    """Groups of all sizes, chains, copies, and pairs on both sides of the threshold."""
    centre = rng.normal(size=(12, dims))
    big = centre[0] + rng.normal(size=(n // 3, dims)) * width
    some = centre[rng.integers(1, 12, n // 4)] + rng.normal(size=(n // 4, dims)) * width
    turn = np.linspace(0, 3, n // 8)
    chain = np.zeros((len(turn), dims))
    chain[:, 0], chain[:, 1] = np.cos(turn), np.sin(turn)
    x = np.concatenate([big, some, chain, rng.normal(size=(n // 8, dims)), np.repeat(centre[3:4], n // 8, 0), 2.5 * some[:20]])
    return x.astype(np.float32)


@pytest.mark.parametrize(("width", "dims", "tile", "tiles", "pivots"), [
    (0.1, 16, 50, 4096, 4), (0.23, 16, 64, 4096, 3), (0.23, 8, 10_000, 4096, 16), (0.3, 64, 32, 5, 2), (0.25, 32, 16, 4096, 1),
])
def test_against_all_pairs(spark, width, dims, tile, tiles, pivots):
    rng = np.random.default_rng(dims + tile)
    x = clouds(rng, 480, width, dims)
    ids = rng.permutation(5 * len(x))[:len(x)]
    frame = spark.createDataFrame([(int(i), v.tolist(), 1, "x") for i, v in zip(ids, x, strict=True)], SCHEMA)
    found = rows_of(d.near_duplicates(frame, tile=tile, tiles=tiles, pivots=pivots))
    wanted = plain(ids, x)
    assert found == wanted
    assert len({c for _, c in wanted.values()}) > 20 and max(n for n, _ in wanted.values()) > 50


@pytest.mark.parametrize("dims", [3, 64, 2500])
def test_bounds_lose_no_pair(dims):
    rng = np.random.default_rng(dims)
    x = d.unit(np.concatenate([rng.normal(size=(300, dims)), np.eye(dims)[:3], np.full((1, dims), 1.0)]))
    # Around the threshold to within the rounding of int8.
    y = d.unit(0.95 * x + np.sqrt(1 - 0.95 ** 2) * d.unit(rng.normal(size=x.shape)) * rng.uniform(0.97, 1.03, (len(x), 1)))
    q, s, e = d.quantised(x)
    r, t, f = d.quantised(y)
    exact = (q.astype(np.int64) @ r.astype(np.int64).T)
    assert (d.products(q, r) == exact).all()
    off = f[None, :] + e[:, None] * (1 + f[None, :])
    assert (np.abs(s[:, None] * t[None, :] * exact - x @ y.T) <= off + 1e-12).all()
    found = {(i, j) for a, b in d.near_pairs(x, y, 0.95) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    assert found == set(zip(*(c.tolist() for c in np.nonzero((x[:, None] * y[None]).sum(2) >= 0.95)), strict=True))


def test_forest_joins_all_and_only_trees():
    rng = np.random.default_rng(1)
    forest, x, y = d.Forest(500), rng.integers(0, 500, 900), rng.integers(0, 500, 900)
    for some in np.array_split(np.arange(900), 7):
        forest.add(x[some], y[some])
    a, b = forest.links()
    other = d.Forest(500)
    other.add(a, b)
    assert (other.root == forest.root).all()
    assert len(a) == 500 - len(np.unique(forest.root))


def test_tiles_hold_what_they_may():
    counts = [(0, 3, 40), (0, 4, 50), (0, 9, 30), (1, 0, 1), (1, 1, 250), (1, 2, 90), (1, 3, 10)]
    tiles = d.dealt(counts, 100)
    assert tiles == [(0, 3, 0, 1), (0, 4, 0, 1), (0, 9, 1, 1), (1, 0, 2, 1), (1, 1, 3, 3), (1, 2, 6, 1), (1, 3, 6, 1)]


def test_far_tiles_do_not_meet(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([d.unit(np.eye(8)[i] + rng.normal(size=(200, 8)) * 0.02) for i in range(8)])
    frame = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "id bigint, n bigint, v array<double>")
    _, ranges = d.tiled(frame, 100, 4096, 8)
    n = ranges.count()
    assert d.meetings(ranges, 0.95).count() < n * n / 3


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(5, [1.0, 0.0]), (3, [1.0, 0.1]), (9, [1.0, 0.0]), (4, [-1.0, 0.0]), (8, [1e30, 1e29]), (2, [1e-40, 0.0])]
    odd = [(1, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (10, [None, 1.0]), (11, [inf, 0.0]), (12, []), (13, [1.0]), (3, [nan, 1.0]),
           (3, [1.0, 0.1]), (None, [1.0, 0.0]), (None, None)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in good + odd], SCHEMA)
    found = rows_of(d.near_duplicates(frame))
    group = {i: (4, 2) for i in (5, 3, 9, 8, 2)}
    alone = {i: (0, i) for i in (4, 1, 6, 7, 10, 11, 12, 13)}
    assert found == {**group, **alone, None: (0, None)}
    assert d.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows_of(d.near_duplicates(spark.createDataFrame([(1, None, 1, "x")], SCHEMA))) == {1: (0, 1)}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    wanted = duck(sf).execute(ORACLES["op13_vector_dedup"])
    names = [x[0] for x in wanted.description]
    rows = [tuple(r) for r in QUERIES["op13_vector_dedup"](spark, sf).select(*names).collect()]
    assert rows and sorted(rows) == sorted(wanted.fetchall())

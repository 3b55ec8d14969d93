"""Nearest neighbours by inner product, through learned partitions.

On a bounded sample the neighbour graph is worked out and cut into parts of equal
size with few links between them. A small network learns, from a vector, the parts
that its neighbours are in. It then places every row of the table in its most
probable part, and sends a query to as many of its most probable parts as the sample
needs for the recall asked for. In those parts the query is compared with every
vector, in double precision.

A part with many rows is cut into chunks, and so are its queries; chunk meets chunk
in a task of bounded size. Of vectors that are the same only as many rows take part
as can be among the nearest of one query.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rategrid.llm.sample import smallest
from rategrid.llm.store import stash

#: Rows that the parts are learnt on, at most, and of these a part, about.
SAMPLE = 8192
PART = 256
#: Neighbours in the graph.
LINKS = 20
HIDDEN = 128
EPOCHS = 30
#: Recall that the number of parts is chosen for, over sample rows kept from training.
RECALL = 0.97
#: Rows and queries that meet in one task.
ROWS, QUERIES = 8192, 4096


class Model(NamedTuple):
    """Network weights, and how many parts a query visits."""

    layers: list[np.ndarray]
    parts: int
    visits: int

    def odds(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def neighbours(x: np.ndarray, k: int, q: np.ndarray | None = None) -> np.ndarray:
    """Rows of ``x`` nearest to each row of ``q``, or of ``x`` without the row itself."""
    own, q, out = q is None, x if q is None else q, []
    k = min(k, len(x) - own)
    for first in range(0, len(q), 1024):
        s = q[first:first + 1024] @ x.T
        if own:
            s[np.arange(len(s)), np.arange(first, first + len(s))] = -np.inf
        out.append(np.argpartition(-s, max(k - 1, 0), axis=1)[:, :k])
    return np.concatenate(out) if out else np.empty((0, 0), np.int64)


def balanced(x: np.ndarray, links: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Parts of equal size: cuts along main directions first, then moves towards one's links."""
    part, cells, named = np.zeros(len(x), np.int64), [(np.arange(len(x)), parts)], 0
    while cells:
        cell, n = cells.pop()
        if n == 1:
            part[cell], named = named, named + 1
            continue
        _, _, main = np.linalg.svd(x[cell] - x[cell].mean(0), full_matrices=False)
        order, cut = np.argsort(x[cell] @ main[0], kind="stable"), len(cell) * (n // 2) // n
        cells += [(cell[order[:cut]], n // 2), (cell[order[cut:]], n - n // 2)]
    room = -(-len(x) // parts) + max(1, len(x) // parts // 20)
    both = np.concatenate([np.stack([np.repeat(np.arange(len(x)), links.shape[1]), links.ravel()]),
                           np.stack([links.ravel(), np.repeat(np.arange(len(x)), links.shape[1])])], axis=1)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (both[0], part[both[1]]), 1)
        gain = votes.max(1) - votes[np.arange(len(x)), part]
        size, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            for to in np.argsort(-votes[i], kind="stable")[:3]:
                if votes[i, to] > votes[i, part[i]] and size[to] < room:
                    size[part[i]] -= 1
                    size[to] += 1
                    part[i] = to
                    moved += 1
                    break
        if not moved:
            break
    return part


def learn(x: np.ndarray, targets: np.ndarray, seed: int = 3) -> list[np.ndarray]:
    """A network with one hidden layer, by stochastic gradient descent with momentum of two orders."""
    rng = np.random.default_rng(seed)
    scale = np.sqrt((x ** 2).mean()) or 1.0
    layers = [
        rng.normal(0, 1 / (scale * np.sqrt(x.shape[1])), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, targets.shape[1])), np.zeros(targets.shape[1]),
    ]
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    rates = [0.003 / scale / np.sqrt(x.shape[1]), 0.003, 0.003, 0.003]
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            some = order[at:at + 256]
            hidden = x[some] @ layers[0] + layers[1]
            active = np.maximum(hidden, 0)
            z = active @ layers[2] + layers[3]
            p = np.exp(z - z.max(1, keepdims=True))
            back = (p / p.sum(1, keepdims=True) - targets[some]) / len(some)
            inner = (back @ layers[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((x[some].T @ inner, inner.sum(0), active.T @ back, back.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                grown = first[i] / (1 - 0.9 ** step)
                layers[i] -= rates[i] * grown / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-9)
    return layers


def fit(x: np.ndarray, k: int, recall: float = RECALL) -> Model:
    """Parts, network and number of visits from the sample's vectors."""
    parts = max(1, len(x) // PART)
    none = [np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
    if parts == 1:
        return Model(none, 1, 1)
    asked, base = x[::10], np.delete(x, np.s_[::10], axis=0)
    links = neighbours(base, LINKS)
    part = balanced(base, links, parts)
    targets = np.zeros((len(base), parts))
    np.add.at(targets, (np.repeat(np.arange(len(base)), links.shape[1]), part[links.ravel()]), 1 / (links.shape[1] + 1))
    np.add.at(targets, (np.arange(len(base)), part), 1 / (links.shape[1] + 1))
    model = Model(learn(base, targets), parts, parts)
    # Rows stand where the network puts them.
    stands = model.odds(base).argmax(1)
    rank = np.argsort(np.argsort(-model.odds(asked), axis=1, kind="stable"), axis=1)
    needed = rank[np.arange(len(asked))[:, None], stands[neighbours(base, k, asked)]].ravel()
    visits = int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1
    return model._replace(visits=visits)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): one row per id, of whole, finite vectors of the commonest length that are not zero."""
    v = F.col("v")
    good = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("v")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists(v, lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    good = good.filter(F.size("v") == (sizes["n"] if sizes else 0))
    return good.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def train(good: DataFrame, k: int, most: int = SAMPLE, recall: float = RECALL) -> Model | None:
    """Fit on at most ``most`` distinct vectors, chosen by hash, in one task. None without rows.

    Of vectors that are the same one takes part, so a common one does not fill the sample.
    """

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [matrix(b.column(0)) for b in batches if b.num_rows]
        if held:
            model = fit(np.concatenate(held), k, recall)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    good = good.groupBy("v").agg(F.min("vec_id").alias("vec_id"))
    sample = smallest(good.withColumn("order", F.xxhash64("vec_id", F.lit(10))), "order", most, "vec_id")
    found = (
        sample.repartition(1).sortWithinPartitions("order", "vec_id").select("v")
        .mapInArrow(fitted, "model binary").first()
    )
    return pickle.loads(bytes(found["model"])) if found else None


def search(
    rows: DataFrame, asked, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    most: int = SAMPLE, recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for the rows where ``asked`` holds.

    ``asked`` is a condition on ``vec_id``. A query meets every other id, ties go to
    the smaller. A query whose parts hold fewer than k rows meets all parts. NULL, zero, non-finite vectors and those of another length than the
    commonest take no part, nor do rows without an id; an id that repeats counts once,
    with its smallest vector. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    good = stash(usable(rows, key, vector), "vectors")
    model = train(good, k, most, recall)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if model is None:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(model)

    def routed(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            near = np.argsort(-held.value.odds(x), axis=1, kind="stable")[:, :n]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))], names=["vec_id", "v", "parts"]
            )

    shape = f"vec_id bigint, v {good.schema['v'].dataType.simpleString()}, parts array<int>"
    same = Window.partitionBy("v").orderBy("vec_id")
    base = good.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1).select("vec_id", "v")
    base = base.mapInArrow(lambda b: routed(b, 1), shape).withColumn("part", F.col("parts")[0]).drop("parts")
    base = stash(base, "placed")
    queries = good.filter(asked).mapInArrow(lambda b: routed(b, held.value.visits), shape)
    queries = stash(queries.withColumn("part", F.explode("parts")).drop("parts"), "routed")

    def sizes(table: DataFrame) -> dict[int, int]:
        # One row per part.
        return {r["part"]: r["count"] for r in table.groupBy("part").count().collect()}

    rows_in = sizes(base)
    cell = ["part", "of_rows", "of_queries"]

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        x, q = (matrix(t["v"].combine_chunks()) for t in (left, right))
        ids, asks = (t["vec_id"].to_numpy() for t in (left, right))
        order = np.argsort(ids)
        x, ids = x[order], ids[order]
        out = []
        for first in range(0, len(q), 256):
            some, who = q[first:first + 256], asks[first:first + 256]
            s = some @ x.T
            s[ids[None, :] == who[:, None]] = -np.inf
            if s.shape[1] > k:
                least = np.partition(s, -k, axis=1)[:, -k]
            else:
                least = np.full(len(s), -np.inf)
            # Products of a matrix may round otherwise from place to place: keep what may tie, and sum anew.
            slack = 1e-9 * (1 + np.abs(least))
            row, at = np.nonzero((s >= np.where(np.isfinite(least), least - slack, -np.inf)[:, None]) & (s > -np.inf))
            exact = (some[row] * x[at]).sum(1)
            order = np.lexsort((ids[at], -exact, row))
            row, at, exact = row[order], at[order], exact[order]
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            row, at, exact = (c[nth < k] for c in (row, at, exact))
            out.append((who[row], ids[at], exact))
        return pa.table([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=names)

    def met(queries: DataFrame) -> DataFrame:
        """The nearest rows of each query in each of its parts, chunk by chunk."""
        asked_in = sizes(queries)
        chunks = spark.createDataFrame(
            [(p, -(-rows_in.get(p, 0) // ROWS) or 1, -(-asked_in.get(p, 0) // QUERIES) or 1) for p in range(model.parts)],
            "part int, of_rows int, of_queries int",
        )

        def dealt(table: DataFrame, mine: str, other: str) -> DataFrame:
            cut = table.join(F.broadcast(chunks), "part")
            own = F.pmod(F.xxhash64("vec_id"), F.col(mine)).cast("int")
            cut = cut.withColumn(mine, own).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            return cut.select("part", "of_rows", "of_queries", "vec_id", "v")

        meet = dealt(base, "of_rows", "of_queries").groupBy(*cell).cogroup(
            dealt(queries, "of_queries", "of_rows").groupBy(*cell)
        )
        return meet.applyInArrow(compared, "query_id bigint, vec_id bigint, score double")

    found = met(queries)
    total = sum(rows_in.values())
    if sum(sorted(rows_in.get(p, 0) for p in range(model.parts))[:model.visits]) <= k and model.visits < model.parts:
        # Parts are so small that a query may lack rows: such queries go to all parts.
        found = stash(found, "found")
        enough = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n")).filter(F.col("n") >= min(k, total - 1))
        lacking = good.filter(asked).join(enough, "vec_id", "left_anti")
        everywhere = stash(lacking.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(model.parts - 1)))), "everywhere")
        again = met(everywhere)
        found = found.join(everywhere.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

"""Connected components of a table of links, by alternating star operations.

Large star hangs every larger neighbour of a node on the smallest one it knows,
small star does so for the smaller neighbours; both are one grouped minimum and one
join, and never gather the neighbours of a node. The rounds end when the links are
the stars of their components; their number grows with the logarithm of the longest
path. Each round is written, so its lineage ends there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rategrid.llm.store import release, stash


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b) with b < a, after one star operation."""
    if large:
        sides = links.select(F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
        )).alias("s")).select("s.*")
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = sides.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        hung = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
    return out.filter("a > b")


def _state(links: DataFrame):
    return links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node that has a link, with the smallest node it reaches.

    ``links`` has two columns of one comparable type, in any order; self links and
    repeats are allowed, rows with NULL are left out. No links give no rows.
    """
    left, right = links.columns
    now = stash(
        links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("a") > F.col("b")))
        .distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        step = stash(_star(_star(now, True), False), "links")
        before, state = state, _state(step)
        release(now)
        now = step
        if tuple(state) == tuple(before):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

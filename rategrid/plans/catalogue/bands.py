"""Money, ordered levels, bands and their comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from rategrid.functions.money import money_to_double
from rategrid.operators.bands import (
    band_parts,
    below_level,
    clean_salaries,
    covered_ticks,
    finish_bands,
    merge_parts,
    ordered_levels,
    overlap_join,
    overlap_ranges,
    salary_bands,
)
from rategrid.plans.registry import query, table
from rategrid.plans.inputs import money, salaries, states_of_suppliers, supplier_salaries

# Posts whose pay range is laid over the bands.
POSTS = [("junior", 1000.0, 20000.0), ("senior", 60000.0, 104000.0), ("none", -10.0, -5.0)]

_BANDS_SQL = """
    SELECT n_name AS state, l_linenumber AS band,
           min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey
"""


def state_bands(spark, sf_dir, threshold=None):
    """Bands by state. Amounts are reduced per supplier before they meet the states,
    so a supplier with many rows is small by the time it is joined."""
    raw = supplier_salaries(spark, sf_dir)
    if threshold is not None:
        raw = below_level(raw, "band", threshold)
    parts = band_parts(clean_salaries(raw), ["s_suppkey", "band"])
    by_state = parts.join(states_of_suppliers(spark, sf_dir), "s_suppkey")
    keys = ["state", "band"]
    return finish_bands(merge_parts(by_state, keys), keys)


@query("salary_bands", _BANDS_SQL + " WHERE l_linenumber < 6 GROUP BY 1, 2")
def _salary_bands(spark, sf_dir):
    return state_bands(spark, sf_dir, threshold=6)


@query(
    "money_clean",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS annual
    FROM orders
    """,
)
def _money_clean(spark, sf_dir):
    # Strings that are no plain decimal.
    bad = (
        F.when(F.col("o_orderstatus") == "F", "12d")
        .when(F.col("o_orderstatus") == "O", "0x1F")
        .otherwise("$ 1,5e3 NaN")
    )
    text = F.when(F.col("o_orderpriority") == "1-URGENT", bad).otherwise(
        money(F.col("o_totalprice"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", money_to_double(text).alias("annual")
    )


@query(
    "bands_na",
    """
    WITH s AS (
      SELECT n_name AS state, l_linenumber AS band,
             CASE WHEN l_linenumber = 7 OR (l_linenumber IN (2, 4) AND l_returnflag = 'R')
                  THEN NULL ELSE l_extendedprice END AS v
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                    JOIN nation ON s_nationkey = n_nationkey)
    SELECT state, band,
           CASE WHEN count(*) = count(v) THEN min(v) END AS lo,
           CASE WHEN count(*) = count(v) THEN max(v) END AS hi,
           min(v) AS lo_known, max(v) AS hi_known
    FROM s GROUP BY 1, 2
    """,
)
def _bands_na(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    unknown = (F.col("l_linenumber") == 7) | (
        F.col("l_linenumber").isin(2, 4) & (F.col("l_returnflag") == "R")
    )
    raw = line.select(
        F.col("l_suppkey").alias("s_suppkey"),
        F.col("l_linenumber").alias("band"),
        F.when(unknown, "by agreement").otherwise(money(F.col("l_extendedprice"))).alias("annual"),
    )
    parts = band_parts(clean_salaries(raw), ["s_suppkey", "band"])
    keys = ["state", "band"]
    by_state = parts.join(states_of_suppliers(spark, sf_dir), "s_suppkey")
    return finish_bands(merge_parts(by_state, keys), keys, na="both")


@query(
    "ordered_levels",
    """
    SELECT 'o_orderpriority' AS variable, o_orderpriority AS level,
           CAST(dense_rank() OVER (ORDER BY o_orderpriority) AS INTEGER) AS ordinal,
           count(*) AS n
    FROM orders GROUP BY o_orderpriority
    UNION ALL
    SELECT 'p_size', CAST(p_size AS VARCHAR),
           CAST(dense_rank() OVER (ORDER BY p_size) AS INTEGER), count(*)
    FROM part GROUP BY p_size
    UNION ALL
    SELECT 'c_name', c_name, CAST(dense_rank() OVER (ORDER BY c_name) AS INTEGER), count(*)
    FROM customer GROUP BY c_name
    """,
)
def _ordered_levels(spark, sf_dir):
    def levels(name, column):
        return ordered_levels(table(spark, sf_dir, name), column).select(
            F.lit(column).alias("variable"), F.col("level").cast("string").alias("level"),
            "ordinal", "n",
        )

    return (
        levels("orders", "o_orderpriority")
        .unionByName(levels("part", "p_size"))
        .unionByName(levels("customer", "c_name"))
    )


@query(
    "ordered_filter",
    """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority < '3-MEDIUM'
    """,
)
def _ordered_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    below = below_level(orders, "o_orderpriority", "3-MEDIUM")
    # No row has the level '3-UNKNOWN', so this part is empty.
    return below.unionByName(below_level(orders, "o_orderpriority", "3-UNKNOWN"))


@query(
    "band_overlap",
    f"""
    WITH b AS ({_BANDS_SQL} GROUP BY 1, 2),
         p(post, post_lo, post_hi) AS (VALUES
           ('junior', CAST(1000 AS DOUBLE), CAST(20000 AS DOUBLE)),
           ('senior', CAST(60000 AS DOUBLE), CAST(104000 AS DOUBLE)),
           ('none', CAST(-10 AS DOUBLE), CAST(-5 AS DOUBLE)))
    SELECT state, band, lo, hi, post, post_lo, post_hi,
           least(hi, post_hi) - greatest(lo, post_lo) AS overlap
    FROM b JOIN p ON lo <= post_hi AND hi >= post_lo
    """,
)
def _band_overlap(spark, sf_dir):
    return overlap_ranges(state_bands(spark, sf_dir), POSTS)


@query(
    "band_overlap_table",
    """
    WITH b AS (
      SELECT l_linenumber AS band, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS step,
             min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
      FROM lineitem GROUP BY 1, 2),
    p AS (SELECT s_name AS post,
                 CASE s_nationkey WHEN 3 THEN CAST('-infinity' AS DOUBLE) ELSE s_acctbal * 9 END
                   AS post_lo,
                 CASE s_nationkey WHEN 24 THEN CAST('infinity' AS DOUBLE)
                   ELSE s_acctbal * 9 + s_nationkey END AS post_hi
          FROM supplier)
    SELECT band, step, lo, hi, post, post_lo, post_hi,
           least(hi, post_hi) - greatest(lo, post_lo) AS overlap
    FROM b JOIN p ON lo <= post_hi AND hi >= post_lo
    """,
)
def _band_overlap_table(spark, sf_dir):
    # Narrow steps of pay and narrow posts, so a post meets a few steps only; the posts
    # of two nations are open below or above.
    raw = supplier_salaries(spark, sf_dir).drop("s_suppkey")
    steps = clean_salaries(raw).withColumn("step", F.floor(F.col("annual") / 1000))
    posts = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("post"),
        F.when(F.col("s_nationkey") == 3, float("-inf")).otherwise(F.col("s_acctbal") * 9)
        .alias("post_lo"),
        F.when(F.col("s_nationkey") == 24, float("inf"))
        .otherwise(F.col("s_acctbal") * 9 + F.col("s_nationkey")).alias("post_hi"),
    )
    return overlap_join(salary_bands(steps, ["band", "step"]), posts)


@query(
    "tick_coverage",
    f"""
    WITH b AS ({_BANDS_SQL} GROUP BY 1, 2),
         t AS (SELECT CAST(range AS BIGINT) AS tick FROM range(0, 180001, 20000))
    SELECT state, band, lo, hi, tick, '$' || format('{{:,}}', tick) AS label
    FROM b JOIN t ON tick BETWEEN lo AND hi
    """,
)
def _tick_coverage(spark, sf_dir):
    return covered_ticks(state_bands(spark, sf_dir))


@query(
    "salary_rows",
    """
    SELECT n_name AS state, ' P-' || l_linenumber || ' ' AS level,
           l_extendedprice AS annual, l_linenumber AS band
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey
    """,
)
def _salary_rows(spark, sf_dir):
    return clean_salaries(salaries(spark, sf_dir)).select("state", "level", "annual", "band")


@query(
    "ordered_levels_text",
    """
    WITH v AS (SELECT CASE p_partkey % 3 WHEN 0 THEN upper(p_type) WHEN 1 THEN lower(p_type)
                        ELSE upper(left(p_type, 1)) || lower(substr(p_type, 2)) END
                      || CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN 'a' WHEN 2 THEN 'B' ELSE 'z' END AS level FROM part),
    n AS (SELECT level, count(*) AS n FROM v GROUP BY level)
    SELECT level, CAST(row_number() OVER (ORDER BY lower(level),
             regexp_replace(regexp_replace(level, '[a-z]', '0', 'g'), '[A-Z]', '1', 'g')) AS INTEGER) AS ordinal, n
    FROM n
    """,
)
def _ordered_levels_text(spark, sf_dir):
    # Upper and lower case side by side, as a locale sorts them, not all capitals first.
    kind, size = F.col("p_partkey") % 3, F.col("p_size") % 4
    level = F.concat(
        F.when(kind == 0, F.upper("p_type")).when(kind == 1, F.lower("p_type")).otherwise(F.initcap("p_type")),
        F.when(size == 0, "").when(size == 1, "a").when(size == 2, "B").otherwise("z"),
    )
    return ordered_levels(table(spark, sf_dir, "part").select(level.alias("level")), "level", "UNICODE")

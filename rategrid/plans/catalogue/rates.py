"""Rate sheets into salaries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rategrid.operators.columns import split_mixed
from rategrid.operators.rates import carry_heading, clean_pay_points, sheet_rates, to_common_band
from rategrid.plans.registry import query, table
from rategrid.plans.inputs import order_sheets
from rategrid.sources.literal import literal_table

# The level line of an order names the section of the customer's next order.
_STEPS = """
    o AS (
      SELECT *, 'LEVEL ' || month(o_orderdate) AS level,
             lag('LEVEL ' || month(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)
               AS above
      FROM orders),
    s AS (
      SELECT o_custkey AS doc_id, 4 * o_orderkey + unnest([3, 4, 5]) AS line_no,
             unnest([above, above, level]) AS section,
             unnest(['Section ' || o_orderpriority, 'Section ' || o_orderpriority, level])
               AS heading,
             unnest(['1st Year', '2nd Year', level]) AS step,
             unnest([[o_totalprice, o_totalprice + 1000],
                     [CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 5 END],
                     [o_totalprice + 7, o_totalprice + 9]]) AS rates
      FROM o)
"""


@query("carry_heading", f"WITH {_STEPS} SELECT doc_id, line_no, section, heading, step FROM s")
def _carry_heading(spark, sf_dir):
    return carry_heading(order_sheets(spark, sf_dir, agreed=True), header_line=1).drop("cells", "labels")


@query(
    "unpivot_rates",
    f"""
    WITH {_STEPS}, r AS (SELECT *, unnest(range(len(rates))) AS i FROM s)
    SELECT doc_id, line_no, section, heading, step, CAST(i + 1 AS INTEGER) AS col_no,
           CASE i WHEN 0 THEN 'current' ELSE '01/07/2022' END AS effective_label,
           CASE i WHEN 0 THEN NULL ELSE '2022-07-01' END AS effective,
           round(rates[i + 1], 2) AS rate,
           CASE WHEN rates[i + 1] IS NULL THEN 'no amount: negotiable' END AS reason
    FROM r
    """,
)
def _unpivot_rates(spark, sf_dir):
    rates = sheet_rates(order_sheets(spark, sf_dir, agreed=True))
    return rates.withColumn("effective", F.col("effective").cast("string"))


@query(
    "mixed_split",
    """
    WITH l AS (
      SELECT o_custkey AS doc_id, 4 * o_orderkey + unnest([2, 3, 4, 5]) AS line_no,
             unnest([['Section ' || o_orderpriority || ' *'],
                     ['1st Year', format('{:,.2f}', o_totalprice),
                      format('{:,.2f}', o_totalprice + 1000)],
                     ['2nd Year', format('{:,.2f}', o_totalprice + 5)],
                     ['LEVEL ' || month(o_orderdate), format('{:,.2f}', o_totalprice + 7),
                      format('{:,.2f}', o_totalprice + 9)]]) AS cells
      FROM orders
      UNION ALL
      SELECT c_custkey, 1, ['Classification', 'current 01/07/2022', '2023-02-01'] FROM customer),
    c AS (SELECT *, unnest(range(len(cells))) AS i FROM l)
    SELECT doc_id, line_no, CAST(i AS INTEGER) AS col_no, cells[i + 1] AS cell FROM c
    """,
)
def _mixed_split(spark, sf_dir):
    return order_sheets(spark, sf_dir).select(
        "doc_id", "line_no", F.posexplode(split_mixed(F.col("line"))).alias("col_no", "cell")
    )


# Part types in the order of their common bands; PROMO has none.
BANDED_TYPES = ["ECONOMY", "SMALL", "MEDIUM", "LARGE", "STANDARD"]


@query(
    "level_crosswalk",
    """
    WITH p AS (
      SELECT p_brand || '/' || p_type AS key,
             CASE WHEN p_brand <> 'Brand#7' THEN
               nullif(list_position(['ECONOMY', 'SMALL', 'MEDIUM', 'LARGE', 'STANDARD'], p_type), 0)
             END AS band
      FROM part)
    SELECT key, CAST(band AS INTEGER) AS band, CASE WHEN band IS NULL THEN 'no band' END AS reason
    FROM p
    """,
)
def _level_crosswalk(spark, sf_dir):
    rows = [
        (f"Brand#{brand}", kind, band)
        for brand in range(1, 26) if brand != 7
        for band, kind in enumerate(BANDED_TYPES, start=1)
    ]
    schema = T.StructType([
        T.StructField("state", T.StringType()), T.StructField("level", T.StringType()),
        T.StructField("band", T.IntegerType()),
    ])
    levels = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("state"), F.concat(F.col("p_type"), F.lit(" #")).alias("level")
    )
    banded = to_common_band(levels, literal_table(spark, rows, schema))
    return banded.select(F.concat_ws("/", "state", "level").alias("key"), "band", "reason")


@query(
    "footnote_clean",
    """
    SELECT p_partkey, right(CAST(p_size AS VARCHAR), 1) AS pay_point
    FROM part WHERE p_type NOT IN ('SMALL', 'LARGE')
    """,
)
def _footnote_clean(spark, sf_dir):
    point = F.right(F.col("p_size").cast("string"), F.lit(1))
    kind = F.col("p_type")
    text = (
        F.when(kind == "PROMO", F.concat(point, F.lit("1")))
        .when(kind == "MEDIUM", F.concat(F.lit(" "), point, F.lit(" *^")))
        .when(kind == "SMALL", "  ")
        .when(kind != "LARGE", point)
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", text.alias("pay_point"))
    return clean_pay_points(rows, "pay_point")

"""Tables from positioned words."""

from __future__ import annotations

from pyspark.sql import functions as F

from rategrid.functions.blocks import number_rows
from rategrid.operators.columns import guess_types, typed_cells
from rategrid.operators.wordgrid import (
    PAGE,
    cell_rows,
    line_cells,
    page_headers,
    placed_words,
    text_lines,
    word_cells,
    word_columns,
    word_table,
)
from rategrid.plans.registry import ORACLES, query, table
from rategrid.plans.inputs import LAST_PAGE, order_words

_PAGE = "length(CAST(doc_id AS VARCHAR))"
_PAGE_OF_CUSTOMER = "length(CAST(c_custkey AS VARCHAR))"
_ROWS = """
    r AS (
      SELECT o_custkey AS doc_id, o_orderkey AS y, o_orderstatus AS status,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS row_no,
             CASE o_orderstatus WHEN 'O' THEN ['extra'] ELSE [] END
             || [o_orderpriority, o_orderstatus, format('{:,.2f}', o_totalprice)]
             || CASE o_orderstatus WHEN 'P' THEN [] ELSE [CAST(year(o_orderdate) AS VARCHAR)] END
               AS cells,
             CASE o_orderstatus WHEN 'O' THEN [NULL, 'label', 'status', 'pay', 'year']
                                WHEN 'P' THEN ['status', 'pay', 'year']
                                ELSE ['label', 'status', 'pay', 'year'] END AS headers
      FROM orders)
"""


@query(
    "word_header",
    f"""
    SELECT c_custkey AS doc_id, {_PAGE_OF_CUSTOMER} AS page_no, CAST(-1 AS BIGINT) AS header_y,
           {LAST_PAGE} AS last_y, 'status|pay|year' AS header
    FROM customer
    """,
)
def _word_header(spark, sf_dir):
    headers = page_headers(text_lines(order_words(spark, sf_dir)))
    return headers.select(
        *PAGE, "header_y", "last_y", F.array_join("header_words", "|").alias("header")
    )


@query(
    "word_cells",
    f"""
    WITH {_ROWS}, c AS (SELECT *, unnest(range(len(cells))) AS i FROM r)
    SELECT doc_id, {_PAGE} AS page_no, y, CAST(i AS INTEGER) AS col_no,
           cells[i + 1] AS cell FROM c
    UNION ALL
    SELECT c_custkey, {_PAGE_OF_CUSTOMER}, -1, unnest([0, 1]), unnest(['status', 'pay year']) FROM customer
    UNION ALL
    SELECT c_custkey, {_PAGE_OF_CUSTOMER}, {LAST_PAGE}, 0, 'end of page' FROM customer
    """,
)
def _word_cells(spark, sf_dir):
    cells = line_cells(placed_words(order_words(spark, sf_dir)))
    return cells.withColumn("col_no", F.col("col_no").cast("int"))


@query(
    "word_align",
    f"""
    WITH {_ROWS}, c AS (SELECT *, unnest(range(len(cells))) AS i FROM r)
    SELECT doc_id, {_PAGE} AS page_no, row_no, CAST(i AS INTEGER) AS col_no,
           headers[i + 1] AS header, cells[i + 1] AS cell FROM c
    """,
)
def _word_align(spark, sf_dir):
    return word_cells(word_table(order_words(spark, sf_dir)))


# The same rows, from words that are never gathered by line.
@query("word_align_long", ORACLES["word_align"])
def _word_align_long(spark, sf_dir):
    return cell_rows(order_words(spark, sf_dir))


@query(
    "word_rows",
    f"""
    WITH {_ROWS}
    SELECT doc_id, {_PAGE} AS page_no, y, row_no FROM r
    UNION ALL
    SELECT c_custkey, {_PAGE_OF_CUSTOMER}, {LAST_PAGE},
           1 + (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) FROM customer
    """,
)
def _word_rows(spark, sf_dir):
    return word_table(order_words(spark, sf_dir), remove_last=False).select(*PAGE, "y", "row_no")


@query(
    "word_line_numbers",
    f"""
    WITH l AS (
      SELECT o_custkey AS doc_id, o_orderkey AS y FROM orders
      UNION ALL SELECT c_custkey, unnest([-1, {LAST_PAGE}]) FROM customer)
    SELECT doc_id, {_PAGE} AS page_no, y,
           row_number() OVER (PARTITION BY doc_id ORDER BY y) AS line_no
    FROM l
    """,
)
def _word_line_numbers(spark, sf_dir):
    lines = order_words(spark, sf_dir).select(*PAGE, "y").distinct()
    return number_rows(lines, PAGE, "y", "line_no")


@query(
    "word_pivot",
    f"""
    WITH {_ROWS}
    SELECT doc_id, {_PAGE} AS page_no, row_no,
           cells[list_position(headers, 'label')] AS label,
           cells[list_position(headers, 'status')] AS status,
           cells[list_position(headers, 'pay')] AS pay,
           cells[list_position(headers, 'year')] AS year
    FROM r
    """,
)
def _word_pivot(spark, sf_dir):
    return word_columns(word_table(order_words(spark, sf_dir)), ["status", "pay", "year"])


@query(
    "word_types",
    f"""
    WITH {_ROWS},
    f AS (SELECT doc_id, unnest(headers) AS header, unnest(cells) AS cell FROM r)
    SELECT doc_id, {_PAGE} AS page_no, header,
           CASE WHEN header IS NULL OR header = 'label' THEN 'character'
                WHEN bool_and(cell IN ('F', 'T')) THEN 'logical'
                WHEN bool_and(regexp_matches(cell, '^[0-9]+$')) THEN 'integer'
                WHEN bool_and(regexp_matches(cell, '^[0-9]+(\\.[0-9]+)?$')) THEN 'double'
                WHEN bool_and(regexp_matches(cell, '^[0-9,]+(\\.[0-9]+)?$')) THEN 'number'
                ELSE 'character' END AS type
    FROM f GROUP BY doc_id, header
    """,
)
def _word_types(spark, sf_dir):
    return guess_types(word_cells(word_table(order_words(spark, sf_dir))), [*PAGE, "header"])


@query(
    "word_values",
    f"""
    WITH {_ROWS},
    f AS (SELECT doc_id, row_no, unnest(range(len(cells))) AS i, unnest(headers) AS header, unnest(cells) AS cell FROM r),
    t AS (SELECT doc_id, header,
            CASE WHEN header IS NULL OR header = 'label' THEN 'character'
                WHEN bool_and(cell IN ('F', 'T')) THEN 'logical'
                WHEN bool_and(regexp_matches(cell, '^[0-9]+$')) THEN 'integer'
                WHEN bool_and(regexp_matches(cell, '^[0-9]+(\\.[0-9]+)?$')) THEN 'double'
                WHEN bool_and(regexp_matches(cell, '^[0-9,]+(\\.[0-9]+)?$')) THEN 'number'
                ELSE 'character' END AS type
          FROM f GROUP BY doc_id, header)
    SELECT f.doc_id, {_PAGE.replace("doc_id", "f.doc_id")} AS page_no, row_no, CAST(i AS INTEGER) AS col_no, f.header, type,
           CASE type WHEN 'logical' THEN cell = 'T' END AS logical,
           CASE type WHEN 'integer' THEN CAST(cell AS BIGINT) END AS integer,
           CASE WHEN type IN ('double', 'number') THEN CAST(replace(cell, ',', '') AS DOUBLE) END AS double,
           CASE type WHEN 'character' THEN cell END AS text
    FROM f JOIN t ON f.doc_id = t.doc_id AND f.header IS NOT DISTINCT FROM t.header
    """,
)
def _word_values(spark, sf_dir):
    typed = typed_cells(word_cells(word_table(order_words(spark, sf_dir))), PAGE, column="header")
    fields = [F.col(f"value.{f}").alias(f) for f in ("logical", "integer", "double", "text")]
    return typed.select(*PAGE, "row_no", "col_no", "header", "type", *fields)


@query(
    "word_cells_one_line",
    """
    WITH w AS (SELECT o_custkey % 5 AS doc_id, o_orderkey AS x, o_orderpriority AS text,
                      o_orderstatus = 'O' AS space FROM orders),
    n AS (SELECT *, coalesce(sum(CASE WHEN space THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY x
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS col_no FROM w)
    SELECT doc_id, CAST(1 AS BIGINT) AS page_no, CAST(0 AS BIGINT) AS y, CAST(col_no AS BIGINT) AS col_no,
           string_agg(text, ' ' ORDER BY x) AS cell
    FROM n GROUP BY doc_id, col_no
    """,
)
def _word_cells_one_line(spark, sf_dir):
    # Five pages, all words of which stand on one line.
    words = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 5).cast("bigint").alias("doc_id"), F.lit(1).cast("bigint").alias("page_no"),
        F.col("o_orderkey").alias("x"), F.lit(0).cast("bigint").alias("y"),
        F.col("o_orderpriority").alias("text"), (F.col("o_orderstatus") == "O").alias("space"),
    )
    return line_cells(placed_words(words))

"""Lines into cells: separators, fixed widths, OCR, column types."""

from __future__ import annotations

from pyspark.sql import functions as F

from rategrid.functions.blocks import number_rows
from rategrid.operators.columns import (
    cut_widths,
    guess_types,
    infer_widths,
    padded_cells,
    repair_ocr,
    sample_lines,
    separate,
    split_ocr,
    split_wide,
    text_cells,
    typed_cells,
)
from rategrid.plans.registry import query, table


@query(
    "split_columns",
    """
    WITH r AS (
      SELECT o_custkey AS doc_id, o_orderkey AS row_no,
             [o_orderpriority, o_orderstatus, '$' || format('{:,.2f}', o_totalprice)]
             || CASE o_orderstatus WHEN 'F' THEN [CAST(year(o_orderdate) AS VARCHAR)]
                                   WHEN 'O' THEN ['a', 'b'] ELSE [] END AS cells
      FROM orders),
    w AS (SELECT *, max(len(cells)) OVER (PARTITION BY doc_id) AS width FROM r),
    c AS (SELECT *, unnest(range(width)) AS i FROM w)
    SELECT doc_id, row_no, CAST(i AS INTEGER) AS col_no, coalesce(cells[i + 1], '') AS cell
    FROM c
    """,
)
def _split_columns(spark, sf_dir):
    status = F.col("o_orderstatus")
    last = F.when(status == "F", F.year("o_orderdate").cast("string")).when(status == "O", "a|b")
    amount = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    line = F.concat_ws("   ", "o_orderpriority", "o_orderstatus", amount, last)
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("row_no"),
        split_wide(line).alias("cells"),
    )
    return padded_cells(rows, ["doc_id"])


_ITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_ITEM_CELLS = """
    ['L' || l_linenumber, l_linestatus, format('{:,.2f}', l_extendedprice)]
    || CASE WHEN l_returnflag <> 'N' THEN [CAST(l_quantity AS VARCHAR)] ELSE [] END
    || CASE WHEN l_returnflag = 'R' THEN [CAST(l_tax AS VARCHAR), CAST(l_discount AS VARCHAR)]
            ELSE [] END
"""


def _item_lines(spark, sf_dir):
    flag = F.col("l_returnflag")
    line = F.concat_ws(
        "  ",
        F.concat(F.lit("L"), F.col("l_linenumber")), "l_linestatus",
        F.format_number("l_extendedprice", 2),
        F.when(flag != "N", F.col("l_quantity").cast("string")),
        F.when(flag == "R", F.concat_ws("    ", F.col("l_tax"), F.col("l_discount"))),
    )
    return table(spark, sf_dir, "lineitem").select(*_ITEM, line.alias("line"))


@query(
    "separate_drop",
    f"""
    WITH c AS (SELECT {', '.join(_ITEM)}, {_ITEM_CELLS} AS cells FROM lineitem)
    SELECT {', '.join(_ITEM)}, cells[1] AS class, cells[2] AS frequency, cells[3] AS pay1,
           cells[4] AS pay2 FROM c
    """,
)
def _separate_drop(spark, sf_dir):
    names = ["class", "frequency", "pay1", "pay2"]
    return _item_lines(spark, sf_dir).select(*_ITEM, *separate(F.col("line"), names))


@query(
    "separate_merge",
    f"""
    WITH c AS (SELECT {', '.join(_ITEM)}, {_ITEM_CELLS} AS cells FROM lineitem)
    SELECT {', '.join(_ITEM)}, cells[1] AS class, cells[2] AS frequency, cells[3] AS pay1,
           cells[4] AS pay2,
           CASE WHEN len(cells) > 4 THEN array_to_string(cells[5:], '|') END AS more FROM c
    """,
)
def _separate_merge(spark, sf_dir):
    names = ["class", "frequency", "pay1", "pay2", "more"]
    return _item_lines(spark, sf_dir).select(
        *_ITEM, *separate(F.col("line"), names, merge_rest=True)
    )


# Parts as one fixed-width document per brand, numbered by part key.
_PARTS = """
    p AS (SELECT p_brand AS doc_id, p_type, CAST(p_size AS VARCHAR) AS size,
                 row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS line_no
          FROM part),
    w AS (SELECT doc_id, max(length(p_type)) AS type_width FROM p GROUP BY doc_id)
"""
# The same from lines 10 to 20 only, or the last line of a shorter document.
_SAMPLED = """
    n AS (SELECT *, max(line_no) OVER (PARTITION BY doc_id) AS lines FROM p),
    s AS (SELECT doc_id, max(length(p_type)) AS type_width, max(length(size)) AS size_width FROM n
          WHERE line_no BETWEEN least(10, lines) AND 20 GROUP BY doc_id)
"""


def _part_lines(spark, sf_dir):
    line = F.concat(F.rpad("p_brand", 10, " "), F.rpad("p_type", 12, " "), F.col("p_size"))
    lines = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("doc_id"), "p_partkey", line.alias("line")
    )
    return number_rows(lines, ["doc_id"], "p_partkey", "line_no").drop("p_partkey")


@query(
    "fwf_infer",
    f"""
    WITH {_PARTS}
    SELECT doc_id, unnest([0, 1, 2]) AS col_no, unnest([0, 10, 22]) AS begin,
           CAST(unnest([length(doc_id), 10 + type_width, NULL]) AS INTEGER) AS "end"
    FROM w
    """,
)
def _fwf_infer(spark, sf_dir):
    return infer_widths(_part_lines(spark, sf_dir), ["doc_id"]).drop("seen")


@query(
    "fwf_infer_sample",
    f"""
    WITH {_PARTS}, {_SAMPLED}
    SELECT doc_id, unnest([0, 1, 2]) AS col_no, unnest([0, 10, 22]) AS begin,
           CAST(unnest([length(doc_id), 10 + type_width, NULL]) AS INTEGER) AS "end",
           CAST(unnest([length(doc_id), 10 + type_width, 22 + size_width]) AS INTEGER) AS seen
    FROM s
    """,
)
def _fwf_infer_sample(spark, sf_dir):
    lines = _part_lines(spark, sf_dir)
    return infer_widths(sample_lines(lines, ["doc_id"], 10, 20, clip=True), ["doc_id"])


@query(
    "fwf_read",
    f"""
    WITH {_PARTS}
    SELECT doc_id, line_no, false AS truncated, unnest([0, 1, 2]) AS col_no,
           unnest([doc_id, p_type, size]) AS cell
    FROM p
    """,
)
def _fwf_read(spark, sf_dir):
    lines = _part_lines(spark, sf_dir)
    return cut_widths(lines, infer_widths(lines, ["doc_id"]), ["doc_id"])


@query(
    "fwf_read_sample",
    f"""
    WITH {_PARTS}, {_SAMPLED}
    SELECT doc_id, line_no, length(p_type) > type_width AS truncated,
           unnest([0, 1, 2]) AS col_no, unnest([doc_id, p_type[:type_width], size]) AS cell
    FROM p JOIN s USING (doc_id)
    """,
)
def _fwf_read_sample(spark, sf_dir):
    # Columns of a few lines: what does not fit them is marked.
    lines = _part_lines(spark, sf_dir)
    widths = infer_widths(sample_lines(lines, ["doc_id"], 10, 20, clip=True), ["doc_id"])
    return cut_widths(lines, widths, ["doc_id"])


def _supplier_cells(spark, sf_dir):
    """One table per nation: name, balance, key, balance with commas, date, flag,
    nothing, and the key with leading zeros."""
    cells = F.array(
        F.col("s_name"),
        F.col("s_acctbal").cast("string"),
        F.col("s_suppkey").cast("string"),
        F.format_number("s_acctbal", 2),
        F.concat(F.lit("2020-02-"), F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0")),
        F.when(F.col("s_acctbal") > 5000, "TRUE").otherwise("F"),
        F.when(F.col("s_acctbal") > 5000, "NA").otherwise(" "),
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0"),
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("doc_id"), F.col("s_suppkey").alias("row_no"),
        F.posexplode(cells).alias("col_no", "cell"),
    )


@query(
    "guess_types",
    """
    WITH s AS (
      SELECT s_nationkey AS doc_id, bool_or(abs(s_acctbal) >= 1000) AS big
      FROM supplier GROUP BY 1)
    SELECT doc_id, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS col_no,
           unnest(['character', 'double', 'integer', CASE WHEN big THEN 'number' ELSE 'double' END,
                   'date', 'logical', 'logical', 'character']) AS type
    FROM s
    """,
)
def _guess_types(spark, sf_dir):
    return guess_types(_supplier_cells(spark, sf_dir), ["doc_id", "col_no"])


@query(
    "cell_values",
    """
    WITH s AS (
      SELECT s_nationkey AS doc_id, bool_or(abs(s_acctbal) >= 1000) AS big
      FROM supplier GROUP BY 1),
    c AS (SELECT *, unnest(range(8)) AS col_no FROM supplier)
    SELECT s_nationkey AS doc_id, s_suppkey AS row_no, CAST(col_no AS INTEGER) AS col_no,
           CASE col_no WHEN 0 THEN 'character' WHEN 1 THEN 'double' WHEN 2 THEN 'integer'
             WHEN 3 THEN CASE WHEN big THEN 'number' ELSE 'double' END WHEN 4 THEN 'date'
             WHEN 7 THEN 'character' ELSE 'logical' END AS type,
           CASE col_no WHEN 5 THEN s_acctbal > 5000 END AS logical,
           CASE col_no WHEN 2 THEN CAST(s_suppkey AS BIGINT) END AS integer,
           CASE WHEN col_no IN (1, 3) THEN s_acctbal END AS double,
           CASE col_no WHEN 4 THEN CAST('2020-02-01' AS DATE) + CAST(s_nationkey AS INTEGER) END AS date,
           CASE col_no WHEN 0 THEN s_name WHEN 7 THEN lpad(CAST(s_suppkey AS VARCHAR), 9, '0') END AS text
    FROM c JOIN s ON s_nationkey = doc_id
    """,
)
def _cell_values(spark, sf_dir):
    typed = typed_cells(_supplier_cells(spark, sf_dir), ["doc_id"])
    fields = [F.col(f"value.{f}").alias(f) for f in ("logical", "integer", "double", "date", "text")]
    return typed.select("doc_id", "row_no", "col_no", "type", *fields)


@query(
    "text_columns",
    """
    SELECT s_nationkey AS doc_id, s_suppkey AS row_no, unnest([0, 7]) AS col_no,
           unnest([s_name, lpad(CAST(s_suppkey AS VARCHAR), 9, '0')]) AS cell
    FROM supplier
    """,
)
def _text_columns(spark, sf_dir):
    return text_cells(_supplier_cells(spark, sf_dir), ["doc_id"])


def _ocr_lines(spark, sf_dir):
    line = F.concat(
        F.lit("AHP"), F.col("p_size"), F.lit("-"), F.right(F.col("p_partkey").cast("string"), F.lit(1)), F.lit(" $ "),
        F.col("p_size") * 1000, F.lit(" p.a. "), F.lit("$"), F.col("p_size") * 2000,
    )
    return table(spark, sf_dir, "part").select("p_partkey", line.alias("line"))


@query(
    "ocr_repair",
    """
    SELECT p_partkey, 'AHP' || p_size || '-' || right(CAST(p_partkey AS VARCHAR), 1) || ' | $' || p_size * 1000
             || ' p.a. $' || p_size * 2000 AS line
    FROM part
    """,
)
def _ocr_repair(spark, sf_dir):
    return _ocr_lines(spark, sf_dir).select("p_partkey", repair_ocr(F.col("line")).alias("line"))


@query(
    "ocr_split",
    """
    SELECT p_partkey, unnest([0, 1, 2]) AS col_no,
           unnest(['AHP' || p_size || '-' || right(CAST(p_partkey AS VARCHAR), 1), '$' || p_size * 1000,
                   '$' || p_size * 2000]) AS cell
    FROM part
    """,
)
def _ocr_split(spark, sf_dir):
    cells = split_ocr(repair_ocr(F.col("line")))
    return _ocr_lines(spark, sf_dir).select(
        "p_partkey", F.posexplode(cells).alias("col_no", "cell")
    )

"""Tables of HTML documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rategrid.functions.arrays import exploded, inlined
from rategrid.operators.html_tables import (
    headed_tables,
    html_tables,
    named_rows,
    newest_table,
    rows_with_header,
    table_cells,
)
from rategrid.plans.registry import query
from rategrid.plans.inputs import part_awards, part_pages, parts

# The cells of both tables of a part page, as (table_no, row_no, col_no, cell).
_CELLS = """
    c AS (
      SELECT p_partkey AS doc_id, p_type, unnest([
        struct_pack(t := 0, r := 0, c := 0, v := 'Field'),
        struct_pack(t := 0, r := 0, c := 1, v := 'Value'),
        struct_pack(t := 0, r := 0, c := 2, v := 'Value'),
        struct_pack(t := 0, r := 1, c := 0, v := 'size'),
        struct_pack(t := 0, r := 1, c := 1, v := CAST(p_size - 1 AS VARCHAR)),
        struct_pack(t := 0, r := 1, c := 2, v := CAST(p_size - 2 AS VARCHAR)),
        struct_pack(t := 1, r := 0, c := 0, v := 'Field'),
        struct_pack(t := 1, r := 0, c := 1, v := 'Value'),
        struct_pack(t := 1, r := 0, c := 2, v := 'Value'),
        struct_pack(t := 1, r := 1, c := 0, v := 'name'),
        struct_pack(t := 1, r := 1, c := 1, v := p_name),
        struct_pack(t := 1, r := 1, c := 2, v := p_brand),
        struct_pack(t := 1, r := 2, c := 0, v := 'type & size'),
        struct_pack(t := 1, r := 2, c := 1, v := p_type),
        struct_pack(t := 1, r := 2, c := 2, v := CAST(p_size AS VARCHAR))]) AS s
      FROM part),
    cells AS (
      SELECT doc_id, p_type, CAST(s.t AS INTEGER) AS table_no, CAST(s.r AS INTEGER) AS row_no,
             CAST(s.c AS INTEGER) AS col_no, s.v AS cell FROM c)
"""
# The newest table is the last one for these types, else the first.
_NEWEST = "table_no = CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'MEDIUM') THEN 1 ELSE 0 END"


def _newest_rows(spark, sf_dir):
    pages = html_tables(part_pages(spark, sf_dir))
    newest = newest_table(F.col("tables"), F.col("order"))
    return pages.select("doc_id", newest.alias("rows"))


@query(
    "html_cells",
    f"WITH {_CELLS} SELECT doc_id, table_no, row_no, col_no, cell FROM cells",
)
def _html_cells(spark, sf_dir):
    return table_cells(html_tables(part_pages(spark, sf_dir)).select("doc_id", "tables"))


@query(
    "html_cells_spanned",
    """
    SELECT p_partkey AS doc_id, unnest([0, 0, 0, 1, 1, 1]) AS row_no,
           unnest([0, 1, 2, 0, 1, 2]) AS col_no,
           unnest([p_brand, p_brand, p_name, p_brand, p_type, CAST(p_size AS VARCHAR)]) AS cell
    FROM part
    """,
)
def _html_cells_spanned(spark, sf_dir):
    # A first row over two columns, its first cell over two rows, end tags left out.
    cell = lambda c: F.concat(F.lit("<td>"), c.cast("string"))
    part = parts(spark, sf_dir).select(
        F.col("p_partkey").alias("doc_id"),
        F.concat(
            F.lit("<table><tr><td rowspan=2>"), "p_brand", cell(F.col("p_brand")),
            cell(F.col("p_name")), F.lit("<tr>"), cell(F.col("p_type")), cell(F.col("p_size")),
            F.lit("</table>"),
        ).alias("html"),
    )
    return table_cells(html_tables(part).select("doc_id", "tables")).drop("table_no")


@query(
    "html_latest_table",
    f"WITH {_CELLS} SELECT doc_id, row_no, col_no, cell FROM cells WHERE {_NEWEST}",
)
def _html_latest_table(spark, sf_dir):
    rows = exploded(_newest_rows(spark, sf_dir), ["doc_id"], "rows", "row_no", "cells")
    return rows.select("doc_id", "row_no", F.posexplode("cells").alias("col_no", "cell"))


_HEADED = f"""
    WITH {_CELLS}
    SELECT b.doc_id, b.row_no, b.col_no, h.cell AS header, b.cell
    FROM cells b JOIN cells h USING (doc_id, table_no, col_no)
    WHERE b.row_no > 0 AND h.row_no = 0 AND b.{_NEWEST.replace('p_type', 'b.p_type')}
"""


@query("header_promote", _HEADED)
def _header_promote(spark, sf_dir):
    cells = rows_with_header(F.col("rows"))
    return inlined(_newest_rows(spark, sf_dir), ["doc_id"], cells, "row_no")


@query(
    "header_promote_cells",
    f"""
    WITH {_CELLS}
    SELECT b.doc_id, b.table_no, b.row_no, b.col_no, h.cell AS header, b.cell
    FROM cells b JOIN cells h USING (doc_id, table_no, col_no)
    WHERE b.row_no > 0 AND h.row_no = 0
    """,
)
def _header_promote_cells(spark, sf_dir):
    # All tables of a document: the header is taken inside its array of rows.
    tables = html_tables(part_pages(spark, sf_dir)).select("doc_id", "tables")
    rows = exploded(tables, ["doc_id"], "tables", "table_no", "rows")
    return inlined(rows, ["doc_id", "table_no"], rows_with_header(F.col("rows")), "row_no")


@query(
    "html_cells_marked",
    """
    SELECT p_partkey AS doc_id, unnest([0, 1, 2, 3]) AS col_no,
           unnest([p_name, p_size || ' < 99 and y > 3', 'AT&T ' || chr(169) || ' 1', p_brand])
             AS cell
    FROM part
    """,
)
def _html_cells_marked(spark, sf_dir):
    # A quoted mark in a tag, bare marks in the text, references without semicolons.
    html = F.concat(
        F.lit('<table><tr><td title="a > b">'), "p_name", F.lit("</td><td>"), F.col("p_size"),
        F.lit(" < 99 and y > 3</td><td>AT&ampT &copy 1</td><td>"), "p_brand",
        F.lit("</td></tr></table>"),
    )
    part = parts(spark, sf_dir).select(F.col("p_partkey").alias("doc_id"), html.alias("html"))
    return table_cells(html_tables(part).select("doc_id", "tables")).drop("table_no", "row_no")


@query(
    "html_named_rows",
    """
    SELECT 'P' || p_partkey AS doc_id, unnest([0, 0, 1, 1]) AS row_no,
           unnest([0, 1, 0, 1]) AS col_no, unnest(['Level', 'Pay', 'Level', 'Pay']) AS header,
           unnest(['1-URGENT', '$' || format('{:,.2f}', p_retailprice), '5-LOW',
                   '$' || format('{:,.2f}', p_retailprice + 1)]) AS cell
    FROM part WHERE p_type NOT IN ('SMALL', 'PROMO')
    """,
)
def _html_named_rows(spark, sf_dir):
    read = headed_tables(html_tables(part_awards(spark, sf_dir)))
    newest = newest_table(F.col("tables"), F.col("order"))
    rows = named_rows(newest, newest_table(F.col("headed"), F.col("order")))
    return inlined(read, ["doc_id"], rows, "row_no")

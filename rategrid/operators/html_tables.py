"""Tables of HTML documents.

A document is one row, and so are all of its tables until one has been chosen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.arrays import exploded
from rategrid.functions.blocks import place
from rategrid.functions.markup import with_headed, with_table_rows, with_tables
from rategrid.operators.links import FORWARD, REVERSE


def html_tables(
    pages: DataFrame, html: str = "html", out: str = "tables", most_span: int | None = None
) -> DataFrame:
    """Add all tables of the document as arrays of rows of cell texts."""
    return with_table_rows(pages, html, out, most_span)


def headed_tables(pages: DataFrame, html: str = "html", out: str = "headed") -> DataFrame:
    """Add, per table, whether its first row holds column names (``<th>`` cells)."""
    return with_headed(pages, html, out)


def tables_and_headings(pages: DataFrame, html: str = "html", tables: str = "tables", headed: str = "headed") -> DataFrame:
    """``html_tables`` and ``headed_tables`` of documents that are read once for both."""
    return with_tables(pages, html, tables, headed)


def named_rows(rows: Column, headed: Column) -> Column:
    """``array<struct<row_no, col_no, header, cell>>`` of a table's rows below its names.

    The first row gives the names where it is ``headed``, else columns are named
    ``X1``, ``X2`` and so on. Rows are filled with NULL to the table's width, so each
    has all columns; numbers count from 0.
    """
    width = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))
    names = F.when(headed, F.get(rows, F.lit(0)))
    body = F.when(headed, F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))).otherwise(rows)
    columns = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(body, lambda row, i: F.transform(columns, lambda j: F.struct(
        i.alias("row_no"), j.alias("col_no"),
        F.coalesce(F.get(names, j), F.concat(F.lit("X"), (j + 1).cast("string"))).alias("header"),
        F.get(row, j).alias("cell"),
    ))))


def newest_table(tables: Column, order: Column) -> Column:
    """Rows of the last table in forward order, of the first one in reverse order."""
    position = F.when(F.lower(order) == FORWARD, -1).when(F.lower(order) == REVERSE, 1)
    return F.try_element_at(tables, position)


def table_cells(df: DataFrame, tables: str = "tables") -> DataFrame:
    """``cells`` rows (table_no, row_no, col_no from 0) of all tables of a document."""
    other = [c for c in df.columns if c != tables]
    rows = exploded(df, other, tables, "table_no", "__rows")
    rows = rows.select(*other, "table_no", F.posexplode("__rows").alias("row_no", "__cells"))
    return rows.select(
        *other, "table_no", "row_no", F.posexplode("__cells").alias("col_no", "cell")
    )


def rows_with_header(rows: Column) -> Column:
    """Cells below the first row, each with its column's first-row text as header."""
    header = F.try_element_at(rows, F.lit(1))
    body = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    return F.flatten(
        F.transform(
            body,
            lambda row, i: F.transform(
                row,
                lambda cell, j: F.struct(
                    (i + 1).alias("row_no"), j.alias("col_no"),
                    F.get(header, j).alias("header"), cell.alias("cell"),
                ),
            ),
        )
    )


def promote_header(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The same for a ``cells`` table: row 0 becomes ``header`` and is dropped."""
    name = F.when(F.col("row_no") == 0, F.col("cell"))
    headed = place(cells, [*keys, "col_no"], "row_no", greatest={"header": name}, shuffle_first=True)
    return headed.where(F.col("row_no") > 0)

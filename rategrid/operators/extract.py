"""Raw tables out of documents of any type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.arrays import inlined
from rategrid.operators.columns import split_wide
from rategrid.operators.html_tables import html_tables, newest_table
from rategrid.operators.links import bad_order
from rategrid.operators.sections import cut_text


def extract_tables(docs: DataFrame, layout: dict[str, Column] | None = None) -> DataFrame:
    """Add ``route``, ``rows`` (``array<struct<row_no, cells>>``) and ``reason``.

    ``docs`` has doc_id, doc_type, html, order, text and the layout columns. HTML
    gives the rows of its newest table, text the split lines of its section; scans
    and other types get a reason instead. One narrow pass serves all types.
    """
    kind = F.lower(F.col("doc_type"))
    known = F.coalesce(kind.isin("html", "pdf"), F.lit(False))
    routed = (
        docs.withColumn("route", F.when(known, kind))
        .withColumn("html", F.when(F.col("route") == "html", F.col("html")))
        .withColumn("text", F.when(F.col("route") == "pdf", F.col("text")))
    )
    read = cut_text(html_tables(routed, out="__tables"), layout)
    newest = newest_table(F.col("__tables"), F.col("order"))
    from_html = F.transform(
        newest, lambda cells, i: F.struct(i.cast("bigint").alias("row_no"), cells.alias("cells"))
    )
    from_text = F.transform(
        "section",
        lambda r: F.struct(r["line_no"].alias("row_no"), split_wide(r["line"]).alias("cells")),
    )
    reason = (
        F.when(kind == "scan.pdf", "scanned document")
        .when(
            ~known,
            F.concat(F.lit("unknown type: "), F.coalesce("doc_type", F.lit("NULL"))),
        )
        .when((F.col("route") == "html") & bad_order(F.col("order")), "bad order")
        .when((F.col("route") == "html") & F.col("rows").isNull(), "no table")
        .when(F.col("route") == "pdf", F.col("reason"))
    )
    return (
        read.withColumn("rows", F.when(F.col("route") == "html", from_html).otherwise(from_text))
        .withColumn("reason", reason)
        .drop("__tables", "section", "html", "text")
    )


def extracted_rows(extracted: DataFrame) -> DataFrame:
    return inlined(extracted, ["doc_id", "route"], "rows", "row_no")


def extract_rejects(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("reason").isNotNull()).select(
        F.coalesce("route", F.lit("doc_type")).alias("stage"),
        F.col("doc_id").cast("string").alias("key"),
        "reason",
    )

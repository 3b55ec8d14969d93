"""The three stages after one another: acquire, extract, analyse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.arrays import inlined
from rategrid.functions.money import money_to_double
from rategrid.functions.text import trim_space
from rategrid.operators.bands import BAND_KEYS, band_parts, finish_bands, merge_parts
from rategrid.operators.columns import split_wide
from rategrid.operators.faults import rejects, with_reason, worked
from rategrid.operators.html_tables import newest_table, tables_and_headings
from rategrid.operators.links import (
    award_path,
    bad_order,
    check_order,
    order_rejects,
    page_rejects,
    resolve_sources,
    source_rejects,
)
from rategrid.operators.rates import crosswalk_rejects, to_common_band
from rategrid.operators.sections import LAYOUT, cut_pages, cut_pages_checked

Picks = tuple[Column, Column]


def acquire(sources: DataFrame, pages: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Registry with ``doc_url`` and ``award_file``; rejects: sources with a bad order, those
    for which no document was found, and addresses with several pages."""
    checked = check_order(sources)
    resolved = resolve_sources(worked(checked), pages)
    registry = resolved.drop("reason").withColumn(
        "award_file", award_path(F.col("state"), F.col("doc_type"), folder)
    )
    rejected = order_rejects(checked).unionByName(source_rejects(resolved))
    return registry, rejected.unionByName(page_rejects(pages))


def _pay_rows(cells: DataFrame, level: Column, amount: Column) -> DataFrame:
    return cells.select(
        "doc_id", "line_no", trim_space(level).alias("level"),
        money_to_double(amount).alias("annual"),
    )


def extract(
    pages: DataFrame, layouts: DataFrame, level: Column, amount: Column
) -> tuple[DataFrame, DataFrame]:
    """Pay rows (doc_id, line_no, level, annual) of paged awards, and rejects.

    ``level`` and ``amount`` pick their value from ``cells``.
    """
    lines, rejected = cut_pages(pages, layouts)
    cells = lines.select("doc_id", "line_no", split_wide(F.col("line")).alias("cells"))
    return _pay_rows(cells, level, amount), rejected


def extract_markup(html: DataFrame, level: Column, amount: Column) -> tuple[DataFrame, DataFrame]:
    """The same for awards in HTML (doc_id, html, order): rows of the newest table.

    A first row of column names is left out.
    """
    read = tables_and_headings(html)
    rows = newest_table(F.col("tables"), F.col("order"))
    read = read.withColumn("rows", rows).withColumn(
        "named", newest_table(F.col("headed"), F.col("order"))
    )
    reason = F.when(bad_order(F.col("order")), "bad order").otherwise("no table")
    read = with_reason(
        read.select("doc_id", "order", "rows", "named"), F.col("rows").isNull(), reason
    )
    numbered = F.transform("rows", lambda r, i: F.struct(i.cast("bigint").alias("line_no"), r.alias("cells")))
    body = F.filter(numbered, lambda r: ~F.col("named") | (r["line_no"] > 0))
    cells = inlined(read.where(F.col("reason").isNull()), ["doc_id"], body, "line_no")
    return _pay_rows(cells, level, amount), rejects(read, "html", F.col("doc_id"))


def extract_any(
    docs: DataFrame, pages: DataFrame, html: DataFrame, text_picks: Picks, html_picks: Picks
) -> tuple[DataFrame, DataFrame]:
    """Pay rows of documents of all types, and a reject for every document without.

    ``docs`` has doc_id, doc_type and the layout columns, one row per document. PDF
    awards are cut out of ``pages``, HTML awards read from ``html``; scans and unknown
    types, documents without text and texts of unknown documents are rejects.
    """
    kind = F.lower("doc_type")
    of_kind = lambda k: docs.where(kind == k)
    known = docs.select("doc_id")
    as_text, as_html = of_kind("pdf"), of_kind("html")
    from_text, no_section = extract(
        pages.join(as_text.select("doc_id"), "doc_id", "left_semi"),
        as_text.select("doc_id", *LAYOUT), *text_picks,
    )
    from_html, no_table = extract_markup(
        html.join(as_html.select("doc_id"), "doc_id", "left_semi"), *html_picks
    )

    def listed(ids: DataFrame, stage: str, reason: Column) -> DataFrame:
        return ids.select(F.lit(stage).alias("stage"), F.col("doc_id").cast("string").alias("key"), reason.alias("reason"))

    unread = docs.where(~F.coalesce(kind.isin("pdf", "html"), F.lit(False)))
    why = F.when(kind == "scan.pdf", "scanned document").otherwise(
        F.concat(F.lit("unknown type: "), F.coalesce("doc_type", F.lit("NULL")))
    )
    page_ids, html_ids = pages.select("doc_id").distinct(), html.select("doc_id").distinct()
    found = [
        listed(unread, "doc_type", why),
        listed(as_text.join(page_ids, "doc_id", "left_anti"), "section", F.lit("no text")),
        listed(as_html.join(html_ids, "doc_id", "left_anti"), "html", F.lit("no text")),
        listed(page_ids.join(known, "doc_id", "left_anti"), "section", F.lit("unknown document")),
        listed(html_ids.join(known, "doc_id", "left_anti"), "html", F.lit("unknown document")),
    ]
    rejected = no_section.unionByName(no_table)
    for more in found:
        rejected = rejected.unionByName(more)
    return from_text.unionByName(from_html), rejected


def analyse(
    rows: DataFrame, docs: DataFrame, crosswalk: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Bands of pay rows; levels without a band and unknown documents as rejects.

    Rows are reduced per document and level before they meet the documents'
    states, so a document of many rows is small by then.
    """
    states = docs.select("doc_id", "state", F.lit(True).alias("__known"))
    parts = band_parts(rows, ["doc_id", "level"]).join(states, "doc_id", "left")
    parts = with_reason(parts, F.col("__known").isNull(), F.lit("unknown document"))
    banded = to_common_band(worked(parts).drop("__known"), crosswalk)
    rejected = rejects(parts, "document", F.col("doc_id")).distinct()
    return (
        finish_bands(merge_parts(worked(banded), BAND_KEYS), BAND_KEYS),
        rejected.unionByName(crosswalk_rejects(banded)),
    )


def extract_checked(
    docs: DataFrame, pages: DataFrame, html: DataFrame, text_picks: Picks, html_picks: Picks
) -> DataFrame:
    """Pay rows and rejects of documents of all types in one frame.

    (doc_id, stage, level, annual, line_no, reason); a row without ``line_no`` stands for
    its document, with the reason for which it gave no rows or NULL. Pages and HTML are read
    once. What the documents themselves say (their type, that they are unknown, that they
    have no text) is added by ``analyse_checked``.
    """
    kind = F.lower("doc_type")
    cut = cut_pages_checked(pages, docs.where(kind == "pdf").select("doc_id", *LAYOUT))
    level, amount = text_picks
    from_text = cut.withColumn("cells", split_wide(F.col("line"))).select(
        "doc_id", F.lit("section").alias("stage"), "line_no", trim_space(level).alias("level"),
        money_to_double(amount).alias("annual"), "reason",
    )
    read = tables_and_headings(html)
    read = read.withColumns({
        "rows": newest_table(F.col("tables"), F.col("order")), "named": newest_table(F.col("headed"), F.col("order")),
    })
    why = F.when(bad_order(F.col("order")), "bad order").otherwise("no table")
    read = with_reason(read.select("doc_id", "order", "rows", "named"), F.col("rows").isNull(), why)
    cells = "struct<line_no: bigint, cells: array<string>>"
    numbered = F.transform("rows", lambda r, i: F.struct(i.cast("bigint").alias("line_no"), r.alias("cells")))
    body = F.filter(numbered, lambda r: ~F.col("named") | (r["line_no"] > 0))
    said = F.concat(F.array(F.lit(None).cast(cells)), F.coalesce(body, F.array().cast(f"array<{cells}>")))
    level, amount = html_picks
    from_html = read.select("doc_id", F.inline(said), "reason").select(
        "doc_id", F.lit("html").alias("stage"), "line_no", trim_space(level).alias("level"),
        money_to_double(amount).alias("annual"), "reason",
    )
    return from_text.unionByName(from_html)


def analyse_checked(rows: DataFrame, docs: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """(state, band, lo, hi, n, n_known, stage, key, reason): parts of bands, and rejects.

    Rows are reduced per document and level before they meet the documents. ``bands_of`` and
    ``rejects_of`` part the frame; it is small by then.
    """
    line = F.col("line_no").isNotNull().alias("is_row")
    parts = band_parts(rows.select("*", line), ["doc_id", "stage", "level", "is_row", "reason"])
    kind = F.lower("doc_type")
    held = docs.select("doc_id", "state", "doc_type", kind.alias("kind"), F.lit(True).alias("known"))
    # Every document without parts comes up as well: it has no text, or is of no type that is read.
    met = parts.withColumnRenamed("reason", "why").join(held, "doc_id", "full")
    own = F.when(kind == "pdf", "section").when(kind == "html", "html").otherwise("doc_type")
    of_type = F.when(kind == "scan.pdf", "scanned document").otherwise(
        F.concat(F.lit("unknown type: "), F.coalesce("doc_type", F.lit("NULL")))
    )
    reason = (
        F.when(F.col("known").isNull(), "unknown document")
        .when(own == "doc_type", of_type)
        .when(F.col("stage").isNull(), "no text")
        .otherwise(F.col("why"))
    )
    # Parts of a text that is not of its document's type say nothing.
    foreign = F.col("known") & F.col("stage").isNotNull() & (own.isin("section", "html") & (own != F.col("stage")))
    met = met.where(~F.coalesce(foreign, F.lit(False))).withColumns({"reason": reason, "stage": F.coalesce(
        F.when(F.col("known") & (own == "doc_type"), "doc_type"), "stage", own
    )})
    # A document's reason is said by the row that stands for it; its other rows are then left out.
    is_row = F.coalesce("is_row", F.lit(False))
    met = met.where(is_row == F.col("reason").isNull()).withColumnRenamed("reason", "failed")
    banded = to_common_band(met, crosswalk)
    unbanded = is_row & F.col("band").isNull()
    return banded.select(
        "state", "band", "lo", "hi", "n", "n_known",
        F.when(unbanded, "crosswalk").otherwise(F.col("stage")).alias("stage"),
        F.when(unbanded, F.concat_ws("/", "state", "level")).when(~is_row, F.col("doc_id").cast("string")).alias("key"),
        F.when(is_row, F.col("reason")).otherwise(F.col("failed")).alias("reason"),
    )


def bands_of(checked: DataFrame) -> DataFrame:
    good = checked.where(F.col("reason").isNull()).select(*BAND_KEYS, "lo", "hi", "n", "n_known")
    return finish_bands(merge_parts(good, BAND_KEYS), BAND_KEYS)


def rejects_of(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select("stage", "key", "reason")

"""Cutting the table section out of a document's text.

Two forms of the same rules. ``cut_text`` is for a document held in one row and
never shuffles. ``cut_pages`` is for documents of many page rows: it places the
section with small facts per page and per block of pages (line counts, last hits)
and then cuts the pages. A document is never gathered into one row or one task.

A layout says where the section is: ``start_pattern``, ``start_offset``,
``end_pattern``, ``end_offset``, ``skip_pattern``. An empty pattern stands for the
first or last line (or nothing to skip); a NULL start or end pattern means the
document is not to be cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.arrays import inlined
from rategrid.functions.blocks import (
    BLOCK,
    KEY,
    across_blocks,
    earlier,
    inside_block,
    place,
    whole,
    with_block,
)
from rategrid.functions.text import (
    Pattern,
    broken,
    compiled,
    drop_blank,
    drop_hits,
    first_match,
    found,
    is_blank,
    last_hit,
    matches,
    numbered,
    split_lines,
)

PAGE_BLOCK = 4096  # pages in a block of a document
LAYOUT = ["start_pattern", "start_offset", "end_pattern", "end_offset", "skip_pattern"]
PATTERNS = ["start_pattern", "end_pattern", "skip_pattern"]
READY = [f"__{name}" for name in PATTERNS]


# --- rules --------------------------------------------------------------------


def section_span(
    n_lines: Column, start_hit: Column, end_hit: Column, layout: dict[str, Column],
    several: Column | None = None, bad: Column | None = None,
) -> Column:
    """``struct<first, last, reason>``; ``reason`` is NULL when there is a section.

    The span is clipped to the document. A span that ends before it starts is
    rejected rather than read backwards, and so is a document with ``several`` layouts
    or a ``bad`` pattern, which names it.
    """
    first = (
        F.when(layout["start_pattern"] == "", F.lit(1)).otherwise(start_hit)
        + layout["start_offset"]
    )
    last = (
        F.when(layout["end_pattern"] == "", n_lines).otherwise(end_hit) + layout["end_offset"]
    )
    reason = (
        F.when(F.lit(False) if several is None else F.coalesce(several, F.lit(False)), "several_layouts")
        .when(F.lit(False) if bad is None else bad.isNotNull(), F.lit(None) if bad is None else bad)
        .when(layout["start_pattern"].isNull() | layout["end_pattern"].isNull(), "no_layout")
        .when(first.isNull(), "no_start")
        .when(last.isNull(), "no_end")
        .when(last < first, "end_before_start")
        .when((last < 1) | (first > n_lines), "outside_document")
    )
    return F.struct(
        F.greatest(first, F.lit(1)).cast("bigint").alias("first"),
        F.least(last, n_lines).cast("bigint").alias("last"),
        reason.alias("reason"),
    )


def layout_columns(prefix: str = "") -> dict[str, Column]:
    return {name: F.col(prefix + name) for name in LAYOUT}


def layout_literals(
    start_pattern: str, start_offset: int, end_pattern: str, end_offset: int, skip_pattern: str
) -> dict[str, Column]:
    values = [start_pattern, start_offset, end_pattern, end_offset, skip_pattern]
    return {name: F.lit(value) for name, value in zip(LAYOUT, values, strict=True)}


def bad_pattern(layout: dict[str, Column]) -> Column:
    """``bad_start_pattern`` and so on for the first pattern that does not compile, else NULL."""
    return F.coalesce(*[F.when(broken(layout[name]), F.lit(f"bad_{name}")) for name in PATTERNS])


def with_ready_patterns(df: DataFrame, layout: dict[str, Column]) -> DataFrame:
    """Add the layout's patterns, compiled once a row, and which of them is bad."""
    ready = {held: compiled(layout[name]) for held, name in zip(READY, PATTERNS, strict=True)}
    return df.withColumns({**ready, "__bad": bad_pattern(layout)})


def _last_hit(lines: Column, ready: str) -> Column:
    return last_hit(lines, lambda line: found(line, F.col(ready)))


def _kept(rows: Column, skip_pattern: Column, skip_blank: bool) -> Column:
    empty = F.coalesce(skip_pattern, F.lit("")) == ""
    rows = F.when(empty, rows).otherwise(drop_hits(rows, F.col(READY[2])))
    return drop_blank(rows) if skip_blank else rows


# --- one row per document -----------------------------------------------------


def cut_text(
    docs: DataFrame,
    layout: dict[str, Column] | None = None,
    text: str = "text",
    skip_blank: bool = True,
) -> DataFrame:
    """Add ``reason`` and ``section`` (``array<struct<line_no, line>>``) to documents."""
    layout = layout or layout_columns()
    lines = F.col("__lines")
    span = section_span(
        F.size(lines),
        _last_hit(lines, READY[0]),
        _last_hit(lines, READY[1]),
        layout,
        bad=F.col("__bad"),
    )
    first, last = F.col("__span.first"), F.col("__span.last")
    cut = numbered(F.slice(lines, first.cast("int"), (last - first + 1).cast("int")), first - 1)
    return (
        with_ready_patterns(docs, layout).withColumn("__lines", split_lines(F.col(text)))
        .withColumn("__span", span)
        .withColumn("reason", F.col("__span.reason"))
        .withColumn(
            "section",
            F.when(F.col("reason").isNull(), _kept(cut, layout["skip_pattern"], skip_blank)),
        )
        .drop("__lines", "__span", "__bad", *READY)
    )


def section_rows(cut: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per kept line of the sections found by ``cut_text``."""
    return inlined(cut, [key], "section", "line_no")


def section_rejects(cut: DataFrame, key: str = "doc_id") -> DataFrame:
    return cut.where(F.col("reason").isNotNull()).select(
        F.lit("section").alias("stage"), F.col(key).cast("string").alias("key"), "reason"
    )


# --- many page rows per document ----------------------------------------------


def page_lines(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines of all pages, numbered through the document."""
    n_lines = F.size(split_lines(F.col("text"))).cast("bigint")
    placed = place(
        pages.select(key, "page_no", "text"), [key], "page_no",
        before={"before": n_lines}, block_rows=PAGE_BLOCK, shuffle_first=True,
    )
    rows = numbered(split_lines(F.col("text")), F.col("before"))
    return inlined(placed, [key], rows, "line_no")


def one_layout(layouts: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: its layout, whether there are ``several`` that differ, and
    its patterns compiled, with the name of one that is bad."""
    held = layouts.groupBy(F.struct(key).alias(KEY)).agg(
        F.min(F.struct(*LAYOUT)).alias("one"), F.max(F.struct(*LAYOUT)).alias("other")
    )
    one = held.select(KEY, "one.*", (F.col("one") != F.col("other")).alias("several"))
    return with_ready_patterns(one, layout_columns())


def page_spans(laid_out: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per block of pages: its lines, the lines before it, and its document's span; the
    document's first page in the block that holds it.

    ``laid_out`` has pages with block, lines above in the block and layout. Each page is
    reduced to its number of lines and last hits; a block of pages becomes one row before
    anything meets the rest of its document.
    """
    lines = F.col("__lines")
    facts = laid_out.withColumn("__lines", split_lines(F.col("text"))).select(
        KEY, BLOCK, "page_no", "above", *LAYOUT, "several", "__bad", READY[2],
        F.size(lines).cast("bigint").alias("n_lines"),
        _last_hit(lines, READY[0]).alias("start_hit"),
        _last_hit(lines, READY[1]).alias("end_hit"),
    )
    # The layout is the same in a document: as a grouping key it needs no sorting.
    blocks = (
        facts.groupBy(KEY, BLOCK, *LAYOUT, "several", "__bad", READY[2])
        .agg(
            F.min("page_no").alias("first_page"),
            F.sum("n_lines").alias("n_lines"),
            F.max(F.col("above") + F.col("start_hit")).alias("start_hit"),
            F.max(F.col("above") + F.col("end_hit")).alias("end_hit"),
        )
    )
    across = across_blocks()
    placed = blocks.withColumn(
        "before", F.coalesce(F.sum("n_lines").over(earlier(across)), F.lit(0))
    ).select(
        KEY, BLOCK, "n_lines", "before", *LAYOUT, "several", "__bad", READY[2],
        F.when(F.col(BLOCK) == F.min(BLOCK).over(whole(across)), F.col("first_page")).alias("first_page"),
        F.sum("n_lines").over(whole(across)).alias("__n"),
        F.max(F.col("before") + F.col("start_hit")).over(whole(across)).alias("__start"),
        F.max(F.col("before") + F.col("end_hit")).over(whole(across)).alias("__end"),
    )
    span = section_span(F.col("__n"), F.col("__start"), F.col("__end"), layout_columns(), F.col("several"), F.col("__bad"))
    return placed.withColumn("span", span).select(
        F.col(f"{KEY}.{key}").alias(key), KEY, BLOCK, "n_lines", "before", "first_page", "skip_pattern", READY[2], "span.*"
    )


def _spans(pages: DataFrame, layouts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Pages by block, with the lines above them in it, and the span of each block's document. Everything is joined on
    (key, block), so the text is shuffled once for both passes."""
    text = pages.select(key, "page_no", "text")
    rows = with_block(text, [key], "page_no", PAGE_BLOCK, shuffle=True)
    blocks = rows.select(KEY, BLOCK).distinct()
    # Below the joins, which keep the order that this needs: pages are sorted once.
    n_lines = F.size(split_lines(F.col("text"))).cast("bigint")
    rows = rows.withColumn("above", F.coalesce(F.sum(n_lines).over(earlier(inside_block("page_no"))), F.lit(0)))
    spread = blocks.join(one_layout(layouts, key), KEY, "left")
    return rows, page_spans(rows.join(spread, [KEY, BLOCK]), key)


def _inside_span() -> Column:
    return (F.col("before") < F.col("last")) & (F.col("before") + F.col("n_lines") >= F.col("first"))


def _cut_lines(placed: DataFrame, skip_blank: bool) -> DataFrame:
    """Add ``__kept``, the page's lines in the span; NULL for pages outside of it."""
    n_lines = F.size("__lines")
    page = (
        placed.withColumn("__lines", split_lines(F.col("text")))
        .withColumn("before", F.col("before") + F.col("above"))
        .withColumn("n_lines", n_lines)
    )
    from_line = F.greatest(F.col("first") - F.col("before"), F.lit(1))
    n_taken = F.least(F.col("last") - F.col("before"), F.col("n_lines")) - from_line + 1
    taken = numbered(
        F.slice(F.col("__lines"), from_line.cast("int"), n_taken.cast("int")),
        F.col("before") + from_line - 1,
    )
    kept = F.when(F.col("reason").isNull() & _inside_span(), _kept(taken, F.col("skip_pattern"), skip_blank))
    return page.withColumn("__kept", kept)


def cut_pages(
    pages: DataFrame, layouts: DataFrame, key: str = "doc_id", skip_blank: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Kept lines (key, line_no, line) of every section, and the rejected documents.

    ``pages`` has one row per (key, page_no) with ``text``; ``layouts`` one row per
    document with the layout columns; a document with layouts that differ is
    rejected. The key may be NULL.
    """
    rows, spans = _spans(pages, layouts, key)
    wanted = spans.where(F.col("reason").isNull() & _inside_span()).drop(key, "first_page", "n_lines")
    cut = _cut_lines(rows.join(wanted, [KEY, BLOCK]), skip_blank)
    lines = inlined(cut.where(F.col("__kept").isNotNull()), [key], "__kept", "line_no")
    return lines, section_rejects(spans.select(key, "reason").distinct(), key)


def cut_pages_checked(
    pages: DataFrame, layouts: DataFrame, key: str = "doc_id", skip_blank: bool = True
) -> DataFrame:
    """(key, line_no, line, reason): the kept lines of ``cut_pages`` and its rejects in one frame.

    Every document has one row without a line besides, which holds its ``reason`` or, for a
    document that was cut, NULL: so the pages are read once for lines, rejects and the list of
    documents that have text.
    """
    rows, spans = _spans(pages, layouts, key)
    wanted = spans.where(F.col("first_page").isNotNull() | (F.col("reason").isNull() & _inside_span())).drop(key, "n_lines")
    cut = _cut_lines(rows.join(wanted, [KEY, BLOCK]), skip_blank)
    none = F.struct(F.lit(None).cast("bigint").alias("line_no"), F.lit(None).cast("string").alias("line"))
    head = F.when(F.col("page_no") == F.col("first_page"), F.array(none))
    said = F.concat(F.coalesce(head, F.array().cast("array<struct<line_no: bigint, line: string>>")),
                    F.coalesce("__kept", F.array().cast("array<struct<line_no: bigint, line: string>>")))
    held = cut.withColumn("__said", said).where(F.size("__said") > 0)
    return held.select(key, F.inline("__said"), "reason")


# --- single steps on lines ----------------------------------------------------


def last_matching_line(lines: DataFrame, pattern: Pattern, key: str = "doc_id") -> DataFrame:
    """Per document the number of its last line with the pattern, from a lines table."""
    hit = F.when(matches(F.col("line"), pattern), F.col("line_no"))
    return lines.groupBy(key).agg(F.max(hit).alias("last_line"))


def without_matching(lines: DataFrame, pattern: Pattern) -> DataFrame:
    """Lines without the pattern. An empty one, and one in a column that is NULL or does
    not compile, keep the line."""
    if isinstance(pattern, str):
        return lines if pattern == "" else lines.where(~matches(F.col("line"), pattern))
    ready = lines.withColumn("__ready", F.when(pattern != "", compiled(pattern)))
    return ready.where(F.col("__ready").isNull() | ~found(F.col("line"), F.col("__ready"))).drop("__ready")


def without_blank(lines: DataFrame, trim: bool = False) -> DataFrame:
    kept = lines.where(~is_blank(F.col("line")))
    return kept.withColumn("line", F.trim("line")) if trim else kept


def only_matching(lines: DataFrame, pattern: Pattern) -> DataFrame:
    return lines.where(matches(F.col("line"), pattern))


def without_repeats(lines: DataFrame, pattern: Pattern, key: str = "doc_id") -> DataFrame:
    """Drop every line with the pattern but the document's first one."""
    if not isinstance(pattern, str):
        lines, pattern = lines.withColumn("__ready", compiled(pattern)), F.col("__ready")
    hit = matches(F.col("line"), pattern) if isinstance(pattern, str) else found(F.col("line"), pattern)
    hit = F.coalesce(hit, F.lit(False))
    placed = place(lines, [key], "line_no", least={"__first": F.when(hit, F.col("line_no"))})
    return placed.where(~hit | (F.col("line_no") == F.col("__first"))).drop("__first", "__ready")


def without_repeats_in(docs: DataFrame, rows: str, pattern: Pattern) -> DataFrame:
    """The same for the numbered lines of documents held in one row each."""
    first = first_match(F.transform(rows, lambda r: r["line"]), pattern)
    if not isinstance(pattern, str):
        docs, pattern = docs.withColumn("__ready", compiled(pattern)), F.col("__ready")
    hit = (lambda e: matches(e, pattern)) if isinstance(pattern, str) else (lambda e: found(e, pattern))
    kept = F.filter(
        rows, lambda r, i: ~F.coalesce(hit(r["line"]), F.lit(False)) | (i + 1 == F.col("__first"))
    )
    return docs.withColumn("__first", first).withColumn(rows, kept).drop("__first", "__ready")


def after_head(rows: Column, n: int) -> Column:
    """Numbered lines without the first ``n``."""
    return F.slice(rows, n + 1, F.greatest(F.size(rows) - n, F.lit(0)))


def head(rows: Column, n: int) -> Column:
    return F.slice(rows, 1, n)


def pages_matching(pages: DataFrame, pattern: Pattern, text: str = "text") -> DataFrame:
    """Pages that hold the pattern, before they are split."""
    return pages.where(matches(F.col(text), pattern))


def text_check(pages: DataFrame, key: str = "doc_id", at_least: int = 15) -> DataFrame:
    """Whether a document holds text and all of its expected pages were read.

    ``pages`` may carry ``pages_expected``; without it every document is complete.
    """
    expected = (
        F.max("pages_expected") if "pages_expected" in pages.columns else F.count(F.lit(1))
    )
    long_page = F.coalesce(F.length("text") > at_least, F.lit(False))
    return pages.groupBy(key).agg(
        F.bool_or(long_page).alias("has_text"),
        F.count(F.lit(1)).alias("pages_read"),
        (F.count(F.lit(1)) == expected).alias("complete"),
    )

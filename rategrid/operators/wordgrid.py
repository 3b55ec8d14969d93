"""Tables from positioned words (doc_id, page_no, x, y, text, space).

Two forms of the same rules. ``cell_rows`` gives one row per cell and never gathers a
text line (one ``y`` of a page): words find their cell by a count of the cells ended before
them, by blocks of ``x``, so a line of any length is spread out. ``word_table`` gives one row
per line, for wide tables, and holds a line's words in it. What a line takes from its
page (header, last line, number of earlier lines) is worked out by blocks of ``y`` in both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.blocks import BLOCK, KEY, place, with_block
from rategrid.functions.text import trim_space

PAGE = ["doc_id", "page_no"]
LABEL = "label"  # name of the first column, which has no header word


def text_lines(words: DataFrame) -> DataFrame:
    """One row per page and ``y`` with its words from left to right."""
    ordered = F.sort_array(F.collect_list(F.struct("x", "text", "space")))
    block = [KEY, BLOCK] if BLOCK in words.columns else []
    return words.groupBy(*PAGE, *block, "y").agg(ordered.alias("words"))


def glued_cells(words: Column) -> Column:
    """Cells of a line: a word followed by a space continues in the next word."""
    start = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open")
    )

    def add(acc: Column, word: Column) -> Column:
        cell = F.concat_ws(" ", acc["open"], word["text"])
        ended = ~F.coalesce(word["space"], F.lit(False))
        return F.struct(
            F.when(ended, F.concat(acc["done"], F.array(cell))).otherwise(acc["done"]).alias("done"),
            F.when(~ended, cell).alias("open"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["open"].isNull(), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["open"]))
        )

    return F.transform(F.aggregate(words, start, add, finish), trim_space)


def page_headers(lines: DataFrame) -> DataFrame:
    """Per page: header words, and the first and last ``y``."""
    return lines.groupBy(*PAGE).agg(
        F.min("y").alias("header_y"),
        F.max("y").alias("last_y"),
        F.transform(F.min_by("words", "y"), lambda w: w["text"]).alias("header_words"),
    )


def aligned_headers(names: Column, cells: Column) -> Column:
    """Header of each cell, lined up from the right; cells too many on the left get NULL."""
    spare = F.size(names) - F.size(cells)
    unnamed = F.array_repeat(F.lit(None).cast("string"), -spare)
    return F.when(spare >= 0, F.slice(names, spare + 1, F.size(cells))).otherwise(
        F.concat(unnamed, names)
    )


def word_table(words: DataFrame, remove_last: bool = True) -> DataFrame:
    """Body lines of every page: (doc_id, page_no, y, row_no, headers, cells)."""
    # Words are shuffled once, by block: lines and block rows are both made from that.
    # The header is a page's first line, so the lines before a row number the rows.
    placed = place(
        text_lines(with_block(words, PAGE, "y", shuffle=True)),
        PAGE,
        "y",
        before={"row_no": F.lit(1).cast("bigint")},
        least={"header": F.struct("y", "words")},
        greatest={"last_y": F.col("y")},
    )
    body = placed.where(F.col("y") > F.col("header.y"))
    if remove_last:
        body = body.where(F.col("y") < F.col("last_y"))
    words_above = F.transform("header.words", lambda w: w["text"])
    read = body.withColumn("cells", glued_cells(F.col("words"))).withColumn(
        "names", F.concat(F.array(F.lit(LABEL)), words_above)
    )
    headers = aligned_headers(F.col("names"), F.col("cells"))
    return read.select(*PAGE, "y", "row_no", headers.alias("headers"), "cells")


def word_cells(table: DataFrame) -> DataFrame:
    """One row per cell, with the header it stands under."""
    pairs = F.arrays_zip(F.col("headers").alias("header"), F.col("cells").alias("cell"))
    return table.select(*PAGE, "row_no", F.posexplode(pairs).alias("col_no", "__pair")).select(
        *PAGE, "row_no", "col_no",
        F.col("__pair.header").alias("header"), F.col("__pair.cell").alias("cell"),
    )


def word_columns(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wide form for known header names, label first. The row already holds all of
    its cells, so nothing is grouped."""
    return table.select(
        *PAGE, "row_no",
        *[
            F.get(F.col("cells"), F.array_position("headers", name).cast("int") - 1).alias(name)
            for name in [LABEL, *names]
        ],
    )


# --- one row per cell -----------------------------------------------------------


def placed_words(words: DataFrame) -> DataFrame:
    """Add to words ``col_no``, the cell of its line that a word is in, and ``at``, its
    number in the line; both count from 0.

    A word followed by a space continues in the next one, so a word's cell is the number
    of words before it that end one. Words at one ``x`` go by their text.
    """
    one = F.lit(1).cast("bigint")
    ended = F.when(~F.coalesce("space", F.lit(False)), one).otherwise(one - 1)
    return place(
        words.select(*PAGE, "x", "y", "text", "space"), [*PAGE, "y"], "x",
        before={"col_no": ended, "at": one}, ties=["text", "space"], shuffle_first=True,
    )


def _cells(placed: DataFrame) -> DataFrame:
    """One row per cell with its words in order; only the words of a cell meet."""
    return placed.groupBy(*PAGE, "y", "col_no").agg(
        F.sort_array(F.collect_list(F.struct("at", "text"))).alias("words")
    )


def _glued(words: Column) -> Column:
    return trim_space(F.array_join(F.transform(words, lambda w: w["text"]), " "))


def line_cells(placed: DataFrame) -> DataFrame:
    """(doc_id, page_no, y, col_no, cell) of placed words."""
    return _cells(placed).select(*PAGE, "y", "col_no", _glued(F.col("words")).alias("cell"))


def cell_rows(words: DataFrame, remove_last: bool = True) -> DataFrame:
    """(doc_id, page_no, row_no, col_no, header, cell) of the body lines of every page.

    Headers are lined up from the right, as in ``aligned_headers``.
    """
    # Cells are made once, by line: lines, names and rows are all read off them.
    page = F.struct(*PAGE).alias("page")
    cells = _cells(placed_words(words))
    lines = cells.groupBy(*PAGE, "y").agg(
        (F.max("col_no") + 1).alias("n_cells"), (F.max(F.element_at("words", -1)["at"]) + 1).alias("n_words")
    )
    # The header is a page's first line, so the lines before a row number the rows. Lines are
    # compared by all they hold, so body and header are read off one table of lines.
    spot = F.struct("y", "n_words", "n_cells")
    ranked = place(
        lines, PAGE, "y", before={"row_no": F.lit(1).cast("bigint")},
        least={"header": spot}, greatest={"last_y": F.col("y")},
    )
    body = ranked.where((spot > F.col("header")) & F.col("header.y").isNotNull())
    if remove_last:
        body = body.where(F.col("y") < F.col("last_y"))
    # A line with as many cells as there are names begins with the label.
    first = F.col("header.n_words") + 1 - F.col("n_cells")
    # A struct is never NULL, so a join on it filters nothing below: all read one shuffle of cells.
    line = F.struct(*PAGE, "y").alias("line")
    body = body.select(line, "row_no", first.alias("first"))
    heads = ranked.where(spot == F.col("header")).select(line)
    names = cells.select(page, line, "words").join(heads, "line").select("page", F.inline("words")).select(
        "page", (F.col("at") + 1).alias("place"), F.col("text").alias("name")
    )
    cells = cells.select(page, line, "col_no", _glued(F.col("words")).alias("cell")).join(body, "line")
    named = cells.withColumn("place", F.col("first") + F.col("col_no")).join(names, ["page", "place"], "left")
    header = F.when(F.col("place") == 0, LABEL).otherwise(F.col("name"))
    return named.select(
        "page.*", "row_no", F.col("col_no").cast("int").alias("col_no"), header.alias("header"), "cell"
    )

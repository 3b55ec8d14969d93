"""Lines into cells.

Line-wise splitting is narrow. What depends on a whole table (its width, its
fixed-width columns, the types of its columns) is first reduced to one small row
per table and then joined back by blocks of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rategrid.functions.arrays import inlined
from rategrid.functions.blocks import place
from rategrid.functions.text import let, trim_space

WIDE_GAP = r"(?U)\s{2,}"  # fixed value: columns are two or more blanks apart
TAB_OR_WIDE_GAP = r"(?U)\t|\s{2,}"


# --- separators ---------------------------------------------------------------


def split_wide(line: Column, n: int = -1) -> Column:
    """Cells of a line; a bar in the text separates as well. ``n`` bounds the number
    of cells, the last one then keeps the rest."""
    return F.split(F.regexp_replace(line, WIDE_GAP, "|"), r"\|", n)


def split_mixed(line: Column) -> Column:
    """Cells set apart by a tab or by two or more blanks."""
    return F.split(line, TAB_OR_WIDE_GAP)


def into_columns(cells: Column, names: Sequence[str]) -> list[Column]:
    """Named cells; missing ones are NULL, further ones are dropped."""
    return [F.get(cells, F.lit(i)).alias(name) for i, name in enumerate(names)]


def separate(line: Column, names: Sequence[str], merge_rest: bool = False) -> list[Column]:
    """A line into named columns. ``merge_rest`` keeps further cells, bars between
    them, in the last column."""
    return into_columns(split_wide(line, len(names) if merge_rest else -1), names)


def unique_names(names: Sequence[str | None]) -> list[str]:
    """Names usable as columns: empty and repeated ones get their position added."""
    given = ["" if name is None else name for name in names]
    return [
        name if name and given.count(name) == 1 else f"{name}...{i}"
        for i, name in enumerate(given, start=1)
    ]


def generated_names(n: int) -> list[str]:
    return [f"c{i}" for i in range(1, n + 1)]


def to_wide(
    rows: DataFrame, names: Sequence[str | None], keys: Sequence[str], cells: str = "cells"
) -> DataFrame:
    """One column per name. The row already holds its cells, so nothing is grouped."""
    return rows.select(*keys, *into_columns(F.col(cells), unique_names(names)))


def padded_cells(
    rows: DataFrame, keys: Sequence[str], cells: str = "cells", row: str = "row_no"
) -> DataFrame:
    """``cells`` rows of ragged tables, each row filled with "" to its table's width."""
    keys = list(keys)
    wide = place(rows, keys, row, greatest={"__width": F.size(cells)}, shuffle_first=True)
    # A sequence down to -1 would count backwards: a table of empty rows has no cells.
    numbers = F.when(F.col("__width") > 0, F.sequence(F.lit(0), F.col("__width") - 1))
    filled = F.transform(numbers, lambda i: F.coalesce(F.get(F.col(cells), i), F.lit("")))
    return wide.select(*keys, row, F.posexplode(filled).alias("col_no", "cell"))


# --- fixed widths -------------------------------------------------------------


def sample_lines(
    lines: DataFrame, keys: Sequence[str], first: int = 1, last: int = 20,
    row: str = "line_no", clip: bool = False,
) -> DataFrame:
    """Lines ``first`` to ``last`` of each document. With ``clip`` the two numbers are
    cut down to the document's last line, so a short document gives that line."""
    keys = list(keys)
    if not clip:
        return lines.where(F.col(row).between(first, last))
    ends = lines.groupBy(*keys).agg(F.max(row).alias("__end"))
    early = lines.where(F.col(row) <= last)
    return early.join(ends, keys).where(
        F.col(row).between(F.least(F.lit(first), F.col("__end")), F.lit(last))
    ).drop("__end")


def _occupied(line: Column) -> Column:
    """``array<struct<word, bits>>``: the positions of a line that are not blank, 64 to a
    number, lowest bit first; words without any are left out."""
    marks = F.regexp_replace(F.regexp_replace(line, r"(?U)\S", "1"), r"(?U)\s", "0")
    last = F.floor((F.length(line) - 1) / 64).cast("int")
    words = F.when(F.length(line) > 0, F.sequence(F.lit(0), last))

    def bits(marks: Column, word: Column) -> Column:
        part = F.reverse(F.substring(marks, word * 64 + 1, F.lit(64)))
        return F.conv(part, 2, -10).cast("bigint")

    held = let(marks, lambda m: F.transform(
        words, lambda w: F.struct(w.alias("word"), bits(m, w).alias("bits"))
    ))
    return F.filter(held, lambda w: w["bits"] != 0)


def infer_widths(lines: DataFrame, keys: Sequence[str], line: str = "line") -> DataFrame:
    """Fixed-width columns of each document from its lines, or from ``sample_lines``.

    A column is a run of character positions that are not blank in every line.
    ``begin`` and ``end`` count from 0, ``end`` is exclusive; the last column is open
    (NULL). ``seen`` is the end of the column as far as the lines show it. A line is one
    bit map for every 64 positions; these are or-ed in each task before they are shuffled,
    and the runs are read off one map per document and 64 positions.
    """
    keys = list(keys)
    maps = (
        inlined(lines, keys, _occupied(F.col(line)), "word")
        .groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
    )
    is_set = lambda i: F.getbit("bits", i) == 1
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), is_set)
    used = maps.select(*keys, F.explode(F.transform(places, lambda i: F.col("word") * 64 + i)).alias("position"))
    by_position = Window.partitionBy(*keys).orderBy("position")
    runs = (
        used.withColumn("run", F.col("position") - F.row_number().over(by_position))
        .groupBy(*keys, "run")
        .agg(F.min("position").alias("begin"), (F.max("position") + 1).alias("end"))
    )
    by_begin = Window.partitionBy(*keys).orderBy("begin")
    return runs.select(
        *keys,
        (F.row_number().over(by_begin) - 1).alias("col_no"),
        "begin",
        F.when(F.lead("begin").over(by_begin).isNotNull(), F.col("end")).alias("end"),
        F.col("end").alias("seen"),
    )


def cut_widths(
    lines: DataFrame, widths: DataFrame, keys: Sequence[str],
    row: str = "line_no", line: str = "line",
) -> DataFrame:
    """Lines into trimmed cells by their document's columns.

    ``truncated`` marks lines that the columns do not fit: text outside of them is
    lost, or a wide gap beyond what the open column was seen to hold shows that it
    holds two. Neither happens with columns inferred from all lines.
    """
    keys = list(keys)
    spec = widths.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("col_no", "begin", "end", "seen"))).alias("__spec")
    )
    text = F.col(line)

    def cut(c: Column) -> Column:
        to = F.coalesce(c["end"], F.length(text))
        return trim_space(F.substring(text, c["begin"] + 1, F.greatest(to - c["begin"], F.lit(0))))

    bare = F.length(F.regexp_replace(text, r"(?U)\s", ""))
    inside = F.aggregate(
        "__cells", F.lit(0),
        lambda acc, cell: acc + F.length(F.regexp_replace(cell, r"(?U)\s", "")),
    )
    last = F.try_element_at("__spec", F.lit(-1))
    beyond = F.substring(text, last["seen"], F.greatest(F.length(text) - last["seen"] + 1, F.lit(0)))
    merged = F.coalesce(beyond.rlike(r"(?U)\s{2,}\S"), F.lit(False))
    return (
        place(lines, keys, row, facts=spec)
        .withColumn("__cells", F.transform("__spec", cut))
        .withColumn("truncated", (bare > inside) | merged)
        .select(*keys, row, "truncated", F.posexplode("__cells").alias("col_no", "cell"))
    )


# --- OCR ----------------------------------------------------------------------

# The gap after "$", a level name before an amount, and the
# separators of a repaired line.
_LOOSE_AMOUNT = r"\$ (\d+)"
_LEVEL_THEN_AMOUNT = r"(-\d) \$"
_OCR_SEPARATOR = r"\||(?<=\d) [^$]* ?(?=\$)"


def repair_ocr(line: Column) -> Column:
    joined = F.regexp_replace(line, _LOOSE_AMOUNT, r"\$$1")
    return F.regexp_replace(joined, _LEVEL_THEN_AMOUNT, r"$1 | \$")


def split_ocr(line: Column) -> Column:
    """Cells of a repaired line: at bars, and between a digit and the next amount."""
    return F.split(line, _OCR_SEPARATOR)


# --- types --------------------------------------------------------------------

# What a cell of each type looks like, tried in this order.
# A number with a leading zero ("007") is text.
_LEADING_ZERO = r"^[-+]?0[0-9]"
TYPE_PATTERNS = [
    ("logical", r"^(?:T|F|TRUE|FALSE|true|false|True|False)$"),
    ("integer", r"^[-+]?[0-9]+$"),
    ("double", r"^[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?$"),
    ("number", r"^-?[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]*)?$|^-?[0-9]+(?:\.[0-9]*)?$"),
    ("time", r"^[0-2]?[0-9]:[0-5][0-9](?::[0-5][0-9])?$"),
    ("date", r"^[0-9]{4}[-/](?:0?[1-9]|1[0-2])[-/](?:0?[1-9]|[12][0-9]|3[01])$"),
    ("datetime", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?Z?$"),
]
_NUMERIC = {"integer", "double", "number"}


def _type_checks(cell: str) -> dict[str, Column]:
    """Per type whether the cell has it; NULL for a cell that says nothing."""
    text = trim_space(F.col(cell))
    value = F.when((text != "") & (text != "NA"), text)
    checks = {}
    for name, pattern in TYPE_PATTERNS:
        fits = value.rlike(pattern)
        if name in _NUMERIC:
            fits = fits & ~value.rlike(_LEADING_ZERO)
        if name == "integer":
            # Whole numbers beyond 64 bits are read as double.
            fits = fits & value.try_cast("bigint").isNotNull()
        checks[f"is_{name}"] = fits
    return checks


def _first_type() -> Column:
    guess = F.lit("character")
    for name, _ in reversed(TYPE_PATTERNS):
        held = F.coalesce(F.col(f"is_{name}"), F.lit(True))
        guess = F.when(held, F.lit(name)).otherwise(guess)
    return guess


def guess_types(cells: DataFrame, keys: Sequence[str], cell: str = "cell") -> DataFrame:
    """Type of each column (keys name one column): the first that all its cells have.

    Empty and "NA" cells say nothing; a column of nothing else is logical.
    """
    checks = _type_checks(cell)
    held = [F.bool_and(check).alias(name) for name, check in checks.items()]
    return cells.groupBy(*keys).agg(*held).select(*keys, _first_type().alias("type"))


#: Fields of a typed value; the one of the column's type is set.
VALUE_FIELDS = ["logical", "integer", "double", "seconds", "date", "datetime", "text"]


def typed_value(cell: Column, kind: Column) -> Column:
    """A cell as a value of a type that ``guess_types`` names.

    A struct of ``logical``, ``integer``, ``double`` (of double and number), ``seconds``
    of the day (of time), ``date``, ``datetime`` and ``text`` (of character), one of which
    is set. Empty and NA cells, and cells that are no value of the type after all (the 30th
    of February), have none.
    """
    text = trim_space(cell)
    given = F.when((text != "") & (text != "NA"), text)
    of = lambda *kinds: F.when(kind.isin(*kinds), given)
    parts = F.split(of("time"), ":")
    part = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit("0")).try_cast("bigint")
    return F.struct(
        F.when(of("logical").isNotNull(), F.upper(given).startswith("T")).alias("logical"),
        of("integer").try_cast("bigint").alias("integer"),
        F.regexp_replace(of("double", "number"), ",", "").try_cast("double").alias("double"),
        F.when(parts.isNotNull(), part(0) * 3600 + part(1) * 60 + part(2)).alias("seconds"),
        F.regexp_replace(of("date"), "/", "-").try_cast("date").alias("date"),
        of("datetime").try_cast("timestamp_ntz").alias("datetime"),
        F.when(kind == "character", cell).alias("text"),
    )


def typed_cells(
    cells: DataFrame, table_keys: Sequence[str], column: str = "col_no", row: str = "row_no", cell: str = "cell"
) -> DataFrame:
    """Add ``type``, guessed from all cells of the column, and ``value`` of that type."""
    checks = _type_checks(cell)
    typed = place(cells, [*table_keys, column], row, least=checks)
    return (
        typed.withColumn("type", _first_type()).drop(*checks)
        .withColumn("value", typed_value(F.col(cell), F.col("type")))
    )


def text_cells(
    cells: DataFrame, table_keys: Sequence[str], row: str = "row_no", cell: str = "cell"
) -> DataFrame:
    """Cells of the columns that are text."""
    checks = _type_checks(cell)
    typed = place(cells, [*table_keys, "col_no"], row, least=checks)
    return typed.where(_first_type() == "character").drop(*checks)


def text_columns(df: DataFrame) -> DataFrame:
    """The text columns of a table with a schema."""
    return df.select([f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])

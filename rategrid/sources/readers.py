"""Inputs: CSV with a header, HTML files, and tables of page text or words."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rategrid.functions.charsets import decoded
from rategrid.operators.faults import rejects

Paths = str | Sequence[str]

#: Column of the CSV reader for a record with too few or too many cells.
CORRUPT = "__corrupt"
#: What a missing cell is read as before it becomes NULL; no text holds it.
_MISSING = "\u0000missing\u0000"


# --- CSV ----------------------------------------------------------------------


def missing_to_null(df: DataFrame) -> DataFrame:
    """Empty and "NA" strings are missing values."""
    return df.select(
        *[
            F.when(~F.col(f.name).isin("", "NA"), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def csv_headers(spark: SparkSession, path: Paths, encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """The files below a path by their header, which is their first line.

    Each file's first line is found by the tasks that read the files; the driver gets one
    row per file.
    """
    lines = spark.read.options(encoding=encoding, recursiveFileLookup=True).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    first = lines.where(F.col("start") == 0).groupBy("path").agg(F.min_by("value", "place").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("path").collect():
        names = next(csv.reader([row["line"].removeprefix("\ufeff")]), [])
        found.setdefault(tuple(n.strip() for n in names), []).append(row["path"])
    return found


def _cells(spark: SparkSession, path: Paths, header: Sequence[str], names: Sequence[str], options: dict) -> DataFrame:
    """All cells as text: those of ``names``, found in the header, and ``CORRUPT``."""
    lower = [h.lower() for h in header]
    unique = len(set(lower)) == len(lower) and "" not in lower
    held = list(header) if unique else [f"__cell{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*held, CORRUPT]])
    # With names of its own a file of another header is found out by the reader.
    read = spark.read.schema(schema).options(
        **options, enforceSchema=not unique, columnNameOfCorruptRecord=CORRUPT, mode="PERMISSIVE"
    ).csv(path if isinstance(path, str) else list(path)).toDF(*[f"__cell{i}" for i in range(len(header))], CORRUPT)
    at = {h: i for i, h in reversed(list(enumerate(lower)))}
    return read.select(
        *[
            (F.col(f"__cell{at[n.lower()]}") if n.lower() in at else F.lit(None).cast("string")).alias(n)
            for n in names
        ],
        # A cell takes part, as the reader gives no record without any.
        F.when(F.coalesce("__cell0", F.lit("")) != CORRUPT, F.col(CORRUPT)).alias(CORRUPT),
    )


def read_csv_checked(
    spark: SparkSession, path: Paths, schema: T.StructType, *, exact: bool = False,
    lines_in_cells: bool = True, each_header: bool = False, encoding: str = "UTF-8",
) -> DataFrame:
    """The columns of ``schema`` of CSV files with a header, ``reason`` and ``record``.

    ``reason`` says what is wrong with a record, or is NULL: it has too few or too many
    cells, or a cell is no value of its column's type (that cell is NULL then).
    ``worked`` and ``csv_rejects`` part the rows. ``record`` is the record as it was read.

    Columns are found by the names in the header, whatever their order or case; a column
    the file lacks is NULL, further ones are left out. Cells in quotes hold commas,
    doubled quotes and line ends (RFC 4180). A byte order mark and CRLF are fine; in a file
    of CRLF lines a line end inside a cell is read as ``\\n``.

    Empty and NA cells are missing, and blanks around cells don't count; with ``exact`` only
    an empty cell without quotes is missing and blanks stay, which reads back what
    ``write_csv(exact=True)`` has written.

    ``lines_in_cells=False`` takes every line as a record: a large file is then read by
    several tasks. All files must have the header of the first, and others stop the job;
    with ``each_header`` every file is read by its own. Files in folders below the path are
    read too; the names of those folders are no columns.
    """
    options = {
        "header": True, "encoding": encoding, "quote": '"', "escape": '"', "multiLine": lines_in_cells,
        "nullValue": _MISSING if exact else "NA", "emptyValue": "",
        "ignoreLeadingWhiteSpace": not exact, "ignoreTrailingWhiteSpace": not exact,
        "recursiveFileLookup": True,
    }
    names = [f.name for f in schema.fields]
    if each_header:
        groups = csv_headers(spark, path, encoding)
    else:
        # Spark reads the first line of one file for this.
        groups = {tuple(spark.read.options(**options).csv(path if isinstance(path, str) else list(path)).columns): path}
    parts = [_cells(spark, files, header, names, options) for header, files in groups.items() if header]
    if not parts:
        parts = [spark.createDataFrame([], ", ".join(f"`{n}` string" for n in [*names, CORRUPT]))]
    cells = parts[0]
    for more in parts[1:]:
        cells = cells.unionByName(more)

    values, wrong = [], []
    for f in schema.fields:
        cell = F.col(f"`{f.name}`")
        given = cell if exact else F.when(~cell.isin("", "NA"), cell)
        if isinstance(f.dataType, T.StringType):
            values.append(given.alias(f.name))
            continue
        value = given.try_cast(f.dataType)
        values.append(value.alias(f.name))
        kind = f.dataType.simpleString()
        wrong.append(F.when(given.isNotNull() & value.isNull(), F.concat(F.lit(f"{f.name} is no {kind}: "), given)))
    count = F.when(F.col(CORRUPT).isNotNull(), F.lit("another number of cells than the header has"))
    record = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])))
    return cells.select(*values, F.coalesce(count, *wrong).alias("reason"), record.alias("record"))


def csv_rejects(checked: DataFrame) -> DataFrame:
    """(stage, key, reason) of the records that do not fit; the key is the record."""
    return rejects(checked, "csv", F.col("record"))


def read_csv(spark: SparkSession, path: Paths, schema: T.StructType, **how) -> DataFrame:
    """CSV with a header; see ``read_csv_checked``, whose options it takes.

    Records with another number of cells are left out, cells that are no value of their
    type are NULL.
    """
    checked = read_csv_checked(spark, path, schema, **how)
    fits = F.coalesce(~F.col("reason").startswith("another number"), F.lit(True))
    return checked.where(fits).select([f.name for f in schema.fields])


# --- HTML ---------------------------------------------------------------------


def read_html_files(spark: SparkSession, path: Paths, default: str = "UTF-8") -> DataFrame:
    """HTML files, one row each: ``path``, ``html`` and the ``charset`` it was read by.

    A byte order mark names the charset, else a ``meta`` element near the start, else it
    is ``default``; one that is not known counts as the default. Empty files give no row.
    """
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    read = files.select("path", decoded(F.col("content"), default).alias("__read"))
    return read.select("path", F.col("__read.text").alias("html"), F.col("__read.charset").alias("charset"))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table of page text, words or cells, with the columns of ``schema``."""
    table = spark.read.parquet(path)
    absent = [f.name for f in schema.fields if f.name not in table.columns]
    if absent:
        raise ValueError(f"{path} lacks columns {absent}")
    return table.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

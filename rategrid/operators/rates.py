"""Rate sheets into salaries: headings, effective dates, footnotes, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.blocks import place
from rategrid.functions.money import (
    money_to_double,
    strip_footnote_digit,
    strip_footnote_marks,
)
from rategrid.functions.text import is_blank, trim_space
from rategrid.operators.columns import split_mixed
from rategrid.operators.faults import rejects

# Fixed value: names that are a heading even on a line with rates of its own.
HEADING_NAME = r"(?i)^\s*(?:level|grade)\s*[0-9]+"
_DATE_AHEAD = r"(?U)\s+(?=[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"


def line_cells(line: Column) -> Column:
    return F.transform(split_mixed(line), trim_space)


def _alone(cells: Column) -> Column:
    """Whether only one cell of the line is not blank."""
    return F.size(F.filter(cells, lambda c: c != "")) == 1


def header_labels(cells: Column) -> Column:
    """Column labels; a cell that also holds a date is two labels."""
    return F.flatten(F.transform(cells, lambda c: F.split(c, _DATE_AHEAD)))


def effective_date(label: Column) -> Column:
    iso = F.regexp_extract(label, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    day_first = F.regexp_extract(label, r"([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1)
    return F.coalesce(
        F.try_to_date(F.nullif(iso, F.lit("")), "yyyy-MM-dd"),
        F.try_to_date(F.nullif(day_first, F.lit("")), "d/M/yyyy"),
    )


def carry_heading(lines: DataFrame, key: str = "doc_id", header_line: int = 0) -> DataFrame:
    """Steps of a sheet: key, line_no, section, heading, step, cells, labels.

    ``heading`` is the nearest heading above a step and ``section`` the nearest one
    named like a level or grade: a sheet may list job titles below a grade. A line
    of one cell is a heading, and so is a line with such a name; a line of several
    cells is a step, with amounts or without.
    ``header_line`` is the number of the line with the column labels; without such
    a line ``labels`` is NULL.
    """
    is_header = F.col("line_no") == header_line
    cells, name, alone = F.col("cells"), F.col("step"), F.col("__alone")
    named = name.rlike(HEADING_NAME)
    carried = place(
        lines.select(key, "line_no", "line").where(~is_blank(F.col("line"))),
        [key],
        "line_no",
        derived={
            "cells": line_cells(F.col("line")),
            "step": strip_footnote_marks(F.get(cells, F.lit(0))),
            "__alone": _alone(cells),
        },
        latest={
            "heading": F.when(~is_header & (alone | named), name),
            "section": F.when(~is_header & named, name),
        },
        greatest={"labels": F.when(is_header, header_labels(cells))},
        shuffle_first=True,
    )
    return carried.where(~is_header & ~alone).select(
        key, "line_no", "section", "heading", "step", "cells", "labels"
    )


def unpivot_rates(steps: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per step and rate column, with the column's label and date.

    A cell that is no amount has no ``rate`` and a ``reason``; blank cells are left out.
    """
    rates = F.slice(F.col("cells"), 2, F.greatest(F.size("cells") - 1, F.lit(0)))
    return (
        steps.select(
            key, "line_no", "section", "heading", "step", "labels",
            F.posexplode(rates).alias("__i", "__rate"),
        )
        .where(F.col("__rate") != "")
        .withColumn("effective_label", F.get("labels", F.col("__i") + 1))
        .withColumn("rate", money_to_double(F.col("__rate")))
        .select(
            key, "line_no", "section", "heading", "step",
            (F.col("__i") + 1).alias("col_no"), "effective_label",
            effective_date(F.col("effective_label")).alias("effective"),
            "rate",
            F.when(
                F.col("rate").isNull(), F.concat(F.lit("no amount: "), F.col("__rate"))
            ).alias("reason"),
        )
    )


def sheet_rates(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rates of sheets whose first line holds the column labels."""
    return unpivot_rates(carry_heading(lines, key, header_line=1), key)


def to_common_band(salaries: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Salaries with the common ``band`` of their (state, level), or a ``reason``."""
    named = salaries.withColumn("level", strip_footnote_marks(F.col("level")))
    joined = named.join(crosswalk.select("state", "level", "band"), ["state", "level"], "left")
    return joined.withColumn("reason", F.when(F.col("band").isNull(), "no band"))


def crosswalk_rejects(banded: DataFrame) -> DataFrame:
    return rejects(banded, "crosswalk", F.concat_ws("/", "state", "level"))


def clean_pay_points(rows: DataFrame, pay_point: str, digits: bool = True) -> DataFrame:
    """Drop rows without a pay point; take the footnote off the others."""
    clean = strip_footnote_digit if digits else strip_footnote_marks
    return rows.where(
        F.col(pay_point).isNotNull() & ~is_blank(F.col(pay_point))
    ).withColumn(pay_point, clean(F.col(pay_point)))

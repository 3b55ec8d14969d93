"""Award-like inputs derived from the given tables.

The tables hold no money strings, award texts, HTML tables or positioned words,
so these are built from their rows: one output row per input row (or a fixed
number of them), nothing grouped, nothing left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rategrid import schemas
from rategrid.operators.combine import with_layouts
from rategrid.plans.registry import table
from rategrid.sources.literal import literal_table

# Page number of the closing page of an award; row pages count up from 1.
LAST_PAGE = 1 << 40
# Parts that one task makes documents of.
SPREAD = 16384


def money(amount: Column) -> Column:
    """`` $78,909.10 ``"""
    return F.concat(F.lit(" $"), F.format_number(amount, 2), F.lit(" "))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts; more than ``SPREAD`` of them are dealt out, ``SPREAD`` a task, by whole rows.

    A part takes some ten bytes in its file and a tenth of a millisecond as a document, so the
    few splits of the file would leave most tasks without work.
    """
    part = table(spark, sf_dir, "part")
    rows = part.count()
    if rows <= SPREAD:
        return part
    return part.repartition(max(rows // SPREAD + 1, spark.sparkContext.defaultParallelism), *part.columns)


def states_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", "state"
    )


def supplier_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary rows (s_suppkey, level, annual text, band), one per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"),
        F.concat(F.lit(" P-"), F.col("l_linenumber"), F.lit(" ")).alias("level"),
        money(F.col("l_extendedprice")).alias("annual"),
        F.col("l_linenumber").alias("band"),
    )


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary rows (state, level, annual text, band), one per line item."""
    return supplier_salaries(spark, sf_dir).join(
        states_of_suppliers(spark, sf_dir), "s_suppkey"
    ).drop("s_suppkey")


# Layouts of the award texts below by nation number. The first two
# kinds cut the same lines; the others give one kind of reject each.
_GOOD = ("PART B", 2, "PART C", -1, r"^\s+\d+$")
_OPEN = ("", 5, "", -2, r"^\s+\d+$")
_NONE = (None, None, None, None, None)
_NO_START = ("PART X", 2, "PART C", -1, "")
_NO_END = ("PART B", 2, "PART D", -1, "")
_BACKWARDS = ("PART B", 2, "Contents", 0, "")


def award_layouts(spark: SparkSession) -> DataFrame:
    """Layouts of NATION_0 to NATION_23; NATION_24 has none."""
    kinds = [_GOOD] * 10 + [_OPEN] * 8 + [_NONE] * 2 + [_NO_START, _NO_END, _BACKWARDS, _GOOD]
    rows = [(f"NATION_{i}", *kind) for i, kind in enumerate(kinds)]
    return literal_table(spark, rows, schemas.LAYOUTS)


def award_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One award per customer: doc_id and state."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("doc_id"), "state"
    )


def award_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page texts of the awards: an opening page with contents, a page for each order
    of the customer (a row, a blank line, a page number), and a closing page."""
    customer = table(spark, sf_dir, "customer")
    opening = customer.select(
        F.col("c_custkey").alias("doc_id"),
        F.lit(0).cast("bigint").alias("page_no"),
        F.lit("Contents\n  PART B  2\n  PART C  9\nPART B\nSalary rates").alias("text"),
    )
    closing = customer.select(
        F.col("c_custkey").alias("doc_id"),
        F.lit(LAST_PAGE).alias("page_no"),
        F.lit("PART C\nSignatures").alias("text"),
    )
    row = F.concat_ws(
        "  ", F.lit(""), "o_orderpriority", "o_orderstatus", F.trim(money(F.col("o_totalprice")))
    )
    footer = F.concat(F.lit("  "), F.col("o_orderkey").cast("string"))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"),
        (F.col("o_orderkey") + 1).alias("page_no"),
        F.concat_ws("\n", row, F.lit(" "), footer).alias("text"),
    )
    return opening.unionByName(rows).unionByName(closing)


def award_doc_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout of each award, NULL where its state has none."""
    return with_layouts(award_docs(spark, sf_dir), award_layouts(spark))


def part_pages(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """HTML per part: two tables of its attributes, and which of them is the newer.
    ``more`` gives further columns of the part."""
    cell = lambda c: F.concat(F.lit("<td> "), c.cast("string"), F.lit(" </td>"))
    row = lambda *cs: F.concat(F.lit("<tr>"), *map(cell, cs), F.lit("</tr>\n"))
    head = F.lit("<tr><td>Field</td><td>Value</td><td>Value</td></tr>\n")
    older = F.concat(F.lit("<table>"), head, row(F.lit("size"), F.col("p_size") - 1,
                     F.col("p_size") - 2), F.lit("</table>"))
    newer = F.concat(
        F.lit('<TABLE class="pay">'), head,
        row(F.lit("name"), F.col("p_name"), F.col("p_brand")),
        row(F.lit("type &amp; size"), F.col("p_type"), F.col("p_size")),
        F.lit("</TABLE>"),
    )
    return parts(spark, sf_dir).select(
        F.col("p_partkey").alias("doc_id"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL", "MEDIUM"), "fwd").otherwise("rev")
        .alias("order"),
        F.concat(
            F.lit("<html><body><!-- <table><tr><td>old</td></tr></table> --><p>Rates</p>"),
            older, F.lit("<p>now</p>"), newer, F.lit("</body></html>"),
        ).alias("html"),
        *more,
    )


def part_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One award in HTML per part: doc_id, state, order and html, a table with names."""
    row = lambda level, pay: F.concat(
        F.lit("<tr><td>"), F.lit(level), F.lit("</td><td>"), money(pay), F.lit("</td></tr>")
    )
    html = F.concat(
        F.lit("<p>a > b</p><table><tr><th>Level</th><th>Pay</th></tr>"),
        row("1-URGENT", F.col("p_retailprice")), row("5-LOW", F.col("p_retailprice") + 1),
        F.lit("</table>"),
    )
    return parts(spark, sf_dir).select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("doc_id"),
        F.concat(F.lit("NATION_"), F.col("p_size") % 25).alias("state"),
        F.when(F.col("p_type") == "PROMO", "newest").otherwise("fwd").alias("order"),
        F.when(F.col("p_type") == "SMALL", "<p>no table</p>").otherwise(html).alias("html"),
    )


def page_sources(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """One source per page, told apart by its address: ``.html`` pages are documents
    themselves, the others index pages; links are newest last on https and newest
    first on http; German pages have no pattern. ``more`` names further columns."""
    return table(spark, sf_dir, "pages").select(
        *more,
        F.concat(F.lit("S"), F.col("page_id")).alias("state"),
        "page_id",
        "url",
        F.when(F.col("url").endswith(".html"), "WEB").otherwise("IDX").alias("type"),
        F.when(~F.col("url").contains("/de/"), "en").alias("pattern"),
        F.when(F.col("url").startswith("https"), "Fwd").otherwise("rev").alias("order"),
    )


def order_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positioned words, one page per customer (numbered by the digits of its key, so
    that page numbers vary): a header line, a line per order and a
    closing line. Priorities of two words make cells of two words; status O has a
    cell too many on the left, status P has none for the year."""

    def words(y: Column, *texts: tuple[Column, Column]) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(10 * i).alias("x"), y.cast("bigint").alias("y"),
                    text.alias("text"), space.alias("space"),
                )
                for i, (text, space) in enumerate(texts)
            ]
        )

    no, yes = F.lit(False), F.lit(True)
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        F.concat(
            words(F.lit(-1), (F.lit("status"), no), (F.lit("pay"), yes), (F.lit("year"), no)),
            words(F.lit(LAST_PAGE), (F.lit("end"), yes), (F.lit("of"), yes), (F.lit("page"), no)),
        ).alias("words"),
    )
    first = F.substring_index("o_orderpriority", " ", 1)
    second = F.nullif(F.substring_index("o_orderpriority", " ", -1), F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"),
        F.filter(
            words(
                F.col("o_orderkey"),
                (F.when(F.col("o_orderstatus") == "O", "extra"), no),
                (first, second.isNotNull()), (second, no), (F.col("o_orderstatus"), no),
                (F.format_number("o_totalprice", 2), no),
                (F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate").cast("string")), no),
            ),
            lambda w: w["text"].isNotNull(),
        ).alias("words"),
    )
    return customer.unionByName(orders).select(
        "doc_id", F.length(F.col("doc_id").cast("string")).cast("bigint").alias("page_no"),
        F.inline("words"),
    )


def order_sheets(spark: SparkSession, sf_dir: str, agreed: bool = False) -> DataFrame:
    """Lines of rate sheets, one sheet per customer: a header line, and per order a
    heading, two steps (tab and blanks) and a heading with rates of its own. With
    ``agreed`` the second step of orders of status P has no amount but a word."""
    price = F.col("o_totalprice")
    level = F.concat(F.lit("LEVEL "), F.month("o_orderdate"))

    def line(i: int, text: Column) -> Column:
        number = F.col("o_orderkey") * 4 + i + 2
        return F.struct(number.alias("line_no"), text.alias("line"))

    def amount(more: int) -> Column:
        return F.format_number(price + more, 2)

    second = amount(5)
    if agreed:
        second = F.when(F.col("o_orderstatus") == "P", "negotiable").otherwise(second)
    lines = F.array(
        line(0, F.concat(F.lit("Section "), F.col("o_orderpriority"), F.lit(" *"))),
        line(1, F.concat_ws("\t", F.lit("1st Year"), amount(0), amount(1000))),
        line(2, F.concat_ws("  ", F.lit("2nd Year"), second)),
        line(3, F.concat_ws("\t", level, amount(7), amount(9))),
    )
    header = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        F.lit(1).cast("bigint").alias("line_no"),
        F.lit("Classification  current 01/07/2022  2023-02-01").alias("line"),
    )
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.inline(lines)
    )
    return header.unionByName(rows)

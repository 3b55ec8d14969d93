"""Newest document of each source, from the links on its index page.

A page is one row; its links stay in one array until a caller wants them one per
row, so nothing up to the join with the sources shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.blocks import place
from rategrid.functions.markup import with_links
from rategrid.functions.text import Pattern, broken, compiled, found, matching
from rategrid.functions.urls import absolute_url, url_key
from rategrid.operators.faults import rejects, with_reason

FORWARD, REVERSE = "fwd", "rev"  # earliest link first / newest link first
SPREAD = 256  # parts of the sources that name one page, at least


def page_links(pages: DataFrame, out: str = "links") -> DataFrame:
    """Add all links of the page in document order; NULL for anchors without one."""
    return with_links(pages, "html", out)


def matching_links(links: Column, pattern: Pattern) -> Column:
    """Links with the pattern, in order. No pattern, an empty one or, in a column, one that
    does not compile: no link."""
    kept = matching(links, pattern)
    if isinstance(pattern, str):
        return kept if pattern else F.array().cast("array<string>")
    given = F.coalesce(pattern, F.lit("")) != ""
    return F.when(given, kept).otherwise(F.array().cast("array<string>"))


def absolute_links(links: Column, base: Column) -> Column:
    return F.transform(links, lambda h: absolute_url(base, h))


def newest_link(links: Column, order: Column) -> Column:
    """Last link in forward order, first one in reverse order, NULL when empty."""
    position = (
        F.when(F.lower(order) == FORWARD, -1).when(F.lower(order) == REVERSE, 1)
    )
    return F.try_element_at(links, position)


def bad_order(order: Column) -> Column:
    return ~F.coalesce(F.lower(order).isin(FORWARD, REVERSE), F.lit(False))


def check_order(sources: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``reason`` to sources whose order can't be used.

    With ``strict`` a bad order stops the job when its row is reached.
    """
    message = F.concat(F.lit("order must be 'fwd' or 'rev', not: "),
                       F.coalesce("order", F.lit("NULL")))
    if strict:
        message = F.raise_error(message).cast("string")
    return with_reason(sources, bad_order(F.col("order")), message)


def order_rejects(checked: DataFrame) -> DataFrame:
    return rejects(checked, "order", F.col("state"))


def check_pattern(sources: DataFrame) -> DataFrame:
    """Add ``reason`` to sources whose pattern does not compile."""
    message = F.concat(F.lit("pattern does not compile: "), F.col("pattern"))
    return with_reason(sources, broken(F.col("pattern")), message)


def pattern_rejects(checked: DataFrame) -> DataFrame:
    return rejects(checked, "pattern", F.col("state"))


def latest_links(index: DataFrame, out: str = "latest") -> DataFrame:
    """Newest matching link of each index row (url, html, pattern, order).

    A pattern that does not compile finds none; ``check_pattern`` names such rows."""
    found = matching_links(F.col("__links"), F.col("pattern"))
    newest = newest_link(F.col("__found"), F.col("order"))
    return (
        page_links(index, "__links")
        .withColumn("__found", found)
        .withColumn(out, absolute_url(F.col("url"), newest))
        .drop("__links", "__found")
    )


def resolve_sources(sources: DataFrame, pages: DataFrame) -> DataFrame:
    """Add ``doc_url``: newest link of an index source, own address of any other; and
    ``reason`` where there is none (``source_rejects``).

    Addresses meet by their normal form (``url_key``), so ``HTTP://H:80/x#top`` finds the
    page ``http://h/x``. Only the links of a page meet the sources, not its markup, and
    they meet each combination of address, pattern and order once. Of several pages of one
    address the link that sorts last counts, so a source stays one row; ``page_rejects``
    lists such addresses. Sources are spread by state, over more parts where there
    are more shuffle partitions, so a page that many of them name is not one join key.
    """
    spread = max(SPREAD, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = ["__url", "__pattern", "__order"]
    keyed = sources.drop("doc_url", "reason").select(
        "*",
        F.coalesce("url", F.lit("")).alias("__url"),
        F.coalesce("pattern", F.lit("")).alias("__pattern"),
        F.coalesce("order", F.lit("")).alias("__order"),
        F.pmod(F.xxhash64("state"), F.lit(spread)).alias("__part"),
    )
    linked = page_links(pages.select(url_key(F.col("url")).alias("__key"), "html")).drop("html")
    # Patterns are compiled once for each combination, before its pages are met.
    wanted = keyed.where(F.col("type") == "IDX").select(*key).distinct().select(
        *key, url_key(F.col("__url")).alias("__key"), compiled(F.col("__pattern")).alias("__ready")
    )
    kept = F.filter("links", lambda h: F.coalesce(found(h, F.col("__ready")), F.lit(False)))
    newest = newest_link(F.when(F.col("__pattern") != "", kept), F.col("__order"))
    latest = wanted.join(linked, "__key", "left").groupBy(*key).agg(
        F.max(absolute_url(F.col("__url"), newest)).alias("__latest"),
        F.max(F.col("links").isNotNull()).alias("__page"),
        F.max(F.col("__ready").isNull()).alias("__bad"),
    )
    indexed = F.col("type") == "IDX"
    reason = F.when(indexed & F.col("__latest").isNull(), (
        F.when(F.col("__pattern") == "", "no pattern")
        .when(F.col("__bad"), F.concat(F.lit("pattern does not compile: "), F.col("__pattern")))
        .when(bad_order(F.col("__order")), "bad order")
        .when(~F.col("__page"), "no index page")
        .otherwise("no matching link")
    )).when(~F.coalesce(indexed, F.lit(False)) & F.col("url").isNull(), "no address")
    return (
        place(keyed, key, "__part", facts=latest, block_rows=1)
        .withColumn("doc_url", F.when(indexed, F.col("__latest")).otherwise(F.col("url")))
        .withColumn("reason", reason)
        .drop(*key, "__part", "__latest", "__page", "__bad")
    )


def source_rejects(resolved: DataFrame) -> DataFrame:
    """Sources without a document address, with what was missing."""
    return rejects(resolved, "source", F.col("state"))


def page_rejects(pages: DataFrame) -> DataFrame:
    """Addresses with several pages, in the spelling that sorts first."""
    counted = pages.groupBy(url_key(F.col("url")).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.min("url").alias("url")
    )
    reason = F.concat(F.col("n").cast("string"), F.lit(" pages of one address"))
    return rejects(with_reason(counted, F.col("n") > 1, reason), "page", F.col("url"))


def award_path(state: Column, doc_type: Column, folder: str) -> Column:
    """Where a source's document is kept: ``folder/STATE.type``."""
    return F.concat_ws("/", F.lit(folder), F.concat_ws(".", F.upper(state), F.lower(doc_type)))

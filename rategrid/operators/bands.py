"""Pay bands: lowest and highest pay per (state, band), and comparing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rategrid.functions.money import dollar_label, money_to_double
from rategrid.functions.ordinals import with_ordinals

BAND_KEYS = ("state", "band")


def clean_salaries(salaries: DataFrame, amount: str = "annual") -> DataFrame:
    return salaries.withColumn(amount, money_to_double(F.col(amount)))


def band_parts(df: DataFrame, keys: Sequence[str], amount: str = "annual") -> DataFrame:
    """Mergeable lowest, highest and counts per key."""
    return df.groupBy(*keys).agg(
        F.min(amount).alias("lo"),
        F.max(amount).alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.count(amount).alias("n_known"),
    )


def merge_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of finer keys put together, so a hot key is reduced before it is joined."""
    return parts.groupBy(*keys).agg(
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum("n").alias("n"),
        F.sum("n_known").alias("n_known"),
    )


def finish_bands(parts: DataFrame, keys: Sequence[str], na: str = "propagate") -> DataFrame:
    """``lo`` and ``hi``. With ``na="propagate"`` one unknown amount makes the band
    unknown, with ``na="ignore"`` it is left out; ``na="both"`` adds the latter as
    ``lo_known`` and ``hi_known``."""
    if na not in ("propagate", "ignore", "both"):
        raise ValueError("na must be 'propagate', 'ignore' or 'both'")
    if na == "ignore":
        return parts.select(*keys, "lo", "hi")
    whole = F.col("n") == F.col("n_known")
    known = [F.col(c).alias(f"{c}_known") for c in ("lo", "hi")] if na == "both" else []
    return parts.select(
        *keys, *[F.when(whole, F.col(c)).alias(c) for c in ("lo", "hi")], *known
    )


def salary_bands(
    salaries: DataFrame,
    keys: Sequence[str] = BAND_KEYS,
    amount: str = "annual",
    na: str = "propagate",
) -> DataFrame:
    return finish_bands(band_parts(salaries, keys, amount), keys, na)


def below_level(df: DataFrame, column: str, threshold, levels: DataFrame | None = None) -> DataFrame:
    """Rows whose ordered value is below ``threshold``.

    A threshold that is not one of the levels compares as unknown, so no row is
    left. ``levels`` holds the variable (``column``) before any filter; by default
    ``df`` itself. The comparison is a plain predicate and reaches the scan.
    """
    known = (df if levels is None else levels).where(F.col(column) == threshold).select(column)
    return df.where(F.col(column) < threshold).where(known.exists())


def ordered_levels(df: DataFrame, column: str, collation: str | None = None) -> DataFrame:
    """Levels of an ordered variable with ordinal and number of rows.

    Levels that are text go by bytes, or by a ``collation`` (``UNICODE``, ``de``, ...)."""
    known = df.where(F.col(column).isNotNull())
    counted = known.groupBy(F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return with_ordinals(counted, collation=collation)


def _overlap(lo: Column, hi: Column, p_lo: Column, p_hi: Column) -> Column:
    return F.least(hi, p_hi) - F.greatest(lo, p_lo)


def overlap_ranges(
    bands: DataFrame, ranges: Sequence[tuple[str, float, float]]
) -> DataFrame:
    """Bands that overlap each of a few given pay ranges, and by how much.

    The ranges are literals in the expression, so this is a narrow step.
    """
    given = F.array(
        *[
            F.struct(
                F.lit(name).alias("post"),
                F.lit(float(lo)).alias("post_lo"),
                F.lit(float(hi)).alias("post_hi"),
            )
            for name, lo, hi in ranges
        ]
    )
    hit = F.filter(
        given, lambda p: (F.col("lo") <= p["post_hi"]) & (F.col("hi") >= p["post_lo"])
    )
    return bands.select("*", F.inline(hit)).withColumn(
        "overlap", _overlap(F.col("lo"), F.col("hi"), F.col("post_lo"), F.col("post_hi"))
    )


def _level_of(lo: Column, hi: Column) -> Column:
    """Smallest k with a width of at most 2**k and bucket numbers that are exact."""
    # Half the width, as the whole may be beyond the largest number.
    width = F.ceil(F.log2(F.greatest(hi / 2 - lo / 2, F.lit(0.5)))) + 1
    size = F.ceil(F.log2(F.greatest(F.abs(lo), F.abs(hi), F.lit(1.0)))) - 51
    return F.greatest(width, size, F.lit(0)).cast("int")


def _bucket(value: Column, level: Column) -> Column:
    # In two steps: 2**1024 is beyond the largest number.
    half = F.floor(level / 2)
    return F.floor(value / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), level - half)).cast("bigint")


def overlap_join(bands: DataFrame, ranges: DataFrame) -> DataFrame:
    """The same for a table of ranges (post, post_lo, post_hi) of any size.

    Each interval lies in at most three buckets of a grid as coarse as itself. A
    pair is found where the finer one of the two looks at the grid of the coarser
    one, so this is an equi-join on (level, bucket), with a few rows per interval
    and level in use, and no pair is tried that is not close.

    Ranges may be open: an infinite end counts as just beyond the last finite end of
    either table for the grid, and as it is for the overlap. Ends that are unknown
    (NULL or NaN) or the wrong way round give no pair.
    """

    def ends(df: DataFrame, lo: str, hi: str) -> DataFrame:
        both = F.array(*[F.when(F.abs(F.col(c)) < float("inf"), F.col(c)) for c in (lo, hi)])
        return df.agg(F.min(F.array_min(both)).alias("least"), F.max(F.array_max(both)).alias("most"))

    # One row: the finite ends of both tables.
    outer = ends(bands, "lo", "hi").unionByName(ends(ranges, "post_lo", "post_hi")).agg(
        F.struct(F.coalesce(F.min("least"), F.lit(0.0)).alias("least"),
                 F.coalesce(F.max("most"), F.lit(0.0)).alias("most"))
    )

    def with_level(df: DataFrame, lo: str, hi: str) -> DataFrame:
        known = df.where((F.col(lo) <= F.col(hi)) & ~F.isnan(lo) & ~F.isnan(hi))
        known = known.withColumn("__outer", outer.scalar())
        inside = lambda c: F.greatest(F.least(F.col(c), F.col("__outer.most")), F.col("__outer.least"))
        return known.withColumns({"__lo": inside(lo), "__hi": inside(hi)}).drop("__outer").withColumn(
            "__level", _level_of(F.col("__lo"), F.col("__hi"))
        )

    def on_grid(df: DataFrame) -> DataFrame:
        grid = F.col("__grid")
        buckets = F.sequence(_bucket(F.col("__lo"), grid), _bucket(F.col("__hi"), grid))
        return df.withColumn("__bucket", F.explode(buckets))

    def at_own(df: DataFrame) -> DataFrame:
        return on_grid(df.withColumn("__grid", F.col("__level"))).drop("__level", "__hi")

    def at_coarser(df: DataFrame, from_level: Column, used: DataFrame) -> DataFrame:
        # Only the grids the other side has intervals on.
        grids = F.filter("__used", lambda g: g >= from_level)
        df = df.withColumn("__used", used.scalar()).withColumn("__grid", F.explode(grids))
        return on_grid(df).drop("__used", "__level", "__hi")

    def used_levels(df: DataFrame) -> DataFrame:
        return df.agg(F.collect_set("__level"))

    b = with_level(bands, "lo", "hi")
    p = with_level(ranges, "post_lo", "post_hi")
    on = ["__grid", "__bucket"]
    named = lambda df: df.withColumnRenamed("__lo", "__post_lo")
    b_on_p = at_coarser(b, F.col("__level"), used_levels(p)).join(named(at_own(p)), on)
    p_on_b = at_own(b).join(named(at_coarser(p, F.col("__level") + 1, used_levels(b))), on)
    # A pair can share several buckets: keep it in the one where both have begun.
    met = F.greatest(F.col("__lo"), F.col("__post_lo"))
    return (
        b_on_p.unionByName(p_on_b)
        .where((F.col("lo") <= F.col("post_hi")) & (F.col("hi") >= F.col("post_lo")))
        .where(F.col("__bucket") == _bucket(met, F.col("__grid")))
        .drop("__grid", "__bucket", "__lo", "__post_lo")
        .withColumn(
            "overlap", _overlap(F.col("lo"), F.col("hi"), F.col("post_lo"), F.col("post_hi"))
        )
    )


def covered_ticks(bands: DataFrame, start: int = 0, stop: int = 180000, step: int = 20000) -> DataFrame:
    """Axis ticks that lie inside each band, with their dollar labels."""
    first = F.greatest(F.ceil((F.col("lo") - start) / step), F.lit(0))
    last = F.least(F.floor((F.col("hi") - start) / step), F.lit((stop - start) // step))
    known = F.col("lo").isNotNull() & F.col("hi").isNotNull()
    steps = F.when(known & (first <= last), F.sequence(first, last))
    return (
        bands.withColumn("tick", F.explode(steps))
        .withColumn("tick", (F.lit(start) + F.col("tick") * step).cast("bigint"))
        .withColumn("label", dollar_label(F.col("tick")))
    )

"""Work and memory of a task that must not follow the size of its table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from rategrid.functions.blocks import place
from rategrid.operators import sections as S
from rategrid.operators.wordgrid import cell_rows
from rategrid.plans.inputs import SPREAD, part_awards, part_pages


@contextmanager
def merged_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_are_dealt_to_all_tasks(spark, tmp_path):
    n = SPREAD + 100
    spark.range(n).coalesce(1).select(
        F.col("id").alias("p_partkey"), F.lit("a b").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
        F.lit("PROMO").alias("p_type"), F.lit(3).alias("p_size"), F.lit(1.5).alias("p_retailprice"),
    ).write.parquet(str(tmp_path / "part.parquet"))
    for docs in (part_pages(spark, str(tmp_path)), part_awards(spark, str(tmp_path))):
        sizes = docs.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == n
        assert max(r["count"] for r in sizes) < n / 2


def test_placed_rows_are_sorted_once(spark, frame):
    rows = frame([(1, 1, 5), (1, 2, 6), (None, 1, 7)], "k int, o bigint, v int")
    with merged_joins(spark):
        placed = place(rows, ["k"], "o", before={"n": F.lit(1).cast("bigint")}, latest={"l": F.col("v")}, shuffle_first=True)
        text = plan(placed)
        assert text.index("SortMergeJoin") < text.index("Window")
        assert sorted((r.k or 0, r.o, r.n, r.l) for r in placed.collect()) == [(0, 1, 0, 7), (1, 1, 0, 5), (1, 2, 1, 6)]


def test_pages_are_sorted_once(spark, frame):
    pages = frame([(1, 0, "x\nPART B\na"), (1, 1, "b\nPART C")], "doc_id int, page_no int, text string")
    layouts = frame([(1, "PART B", 1, "PART C", -1, "")], "doc_id int, start_pattern string, start_offset int, "
                    "end_pattern string, end_offset int, skip_pattern string")
    with merged_joins(spark):
        lines, _ = S.cut_pages(pages, layouts)
        text = plan(lines)
        assert text.index("SortMergeJoin") < text.index("Window")
        assert sorted((r.line_no, r.line) for r in lines.collect()) == [(3, "a"), (4, "b")]


def test_cells_are_made_once(spark, frame):
    words = frame(
        [(1, 1, 0, 1, "pay", False), (1, 1, 0, 2, "a", True), (1, 1, 1, 2, "b", False), (1, 1, 2, 2, "5", False), (1, 1, 0, 3, "end", False),
         (2, 1, 0, None, "pay", False), (2, 1, 0, 2, "a", False), (2, 1, 0, 3, "end", False)],
        "doc_id bigint, page_no bigint, x int, y bigint, text string, space boolean",
    )
    with merged_joins(spark):
        cells = cell_rows(words)
        assert sorted(map(tuple, cells.collect())) == [(1, 1, 1, 0, "label", "a b"), (1, 1, 1, 1, "pay", "5")]
        made = plan(cells).split("== Initial Plan ==")[0]
    # The words of a cell meet behind one shuffle, which names, lines and cells read.
    fresh = [x for x in made.split("\n") if " Exchange hashpartitioning(doc_id" in x and "col_no" in x and "Reused" not in x]
    assert len(fresh) == 1

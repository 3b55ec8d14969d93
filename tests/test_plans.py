"""The plans that the large-scale behaviour rests on."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from rategrid.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the test tables")

# Queries that read markup: a parser in an Arrow function takes what the JVM does not.
MARKUP = {
    "html_cells", "html_cells_spanned", "html_latest_table", "header_promote",
    "header_promote_cells", "link_extract", "link_filter", "link_absolute", "latest_link",
    "resolve_sources", "resolve_sources_doubled", "award_registry", "dispatch_doc_type",
    "link_extract_loose", "html_cells_marked", "html_named_rows", "award_bands_mixed",
    "award_rejects", "pattern_rejects", "source_rejects", "resolve_sources_forms",
    "html_files",
}
# One row per document or line in, no meeting of rows: nothing may be shuffled.
NARROW = {
    "money_clean", "separate_drop", "separate_merge", "ocr_repair", "ocr_split", "html_cells",
    "html_latest_table", "header_promote", "link_extract", "link_filter", "link_absolute",
    "latest_link", "award_path", "mixed_split", "doc_lines", "last_match", "section_text",
    "skip_lines", "skip_blank", "repeat_headers", "page_subset", "skip_head", "head_lines",
    "footnote_clean", "fault_isolated", "dispatch_doc_type", "order_rejects", "combine_states", "ordered_filter",
    "link_extract_loose", "html_cells_marked", "html_named_rows", "skip_lines_nbsp",
    "pattern_rejects", "url_keys",
}


def plan(spark, name, final=False):
    df = QUERIES[name](spark, SF_DIR)
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_row_functions(spark, name):
    text = plan(spark, name)
    assert not re.search("Cartesian|NestedLoop|BatchEvalPython|MapInPandas", text)
    assert ("ArrowEvalPython" in text) <= (name in MARKUP)


@pytest.mark.parametrize("name", sorted(NARROW))
def test_narrow_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_flagship_reads_few_columns_and_filters_in_the_scan(spark):
    text = plan(spark, "salary_bands")
    assert "LessThan(l_linenumber,6)" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_extendedprice:double>" in text


@pytest.mark.parametrize(
    "name", ["order_rejects", "fault_isolated", "level_crosswalk", "header_promote_cells", "split_columns"]
)
def test_good_rows_and_rejects_read_the_table_once(spark, name):
    assert plan(spark, name, final=True).count("FileScan") == 1


@pytest.mark.parametrize("name", ["carry_heading", "doc_lines_paged", "section_slice", "word_pivot"])
def test_wide_rows_are_shuffled_once(spark, name):
    """Both passes over the documents read one shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "ReusedExchange" in plan(spark, name, final=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["carry_heading", "doc_lines_paged", "word_rows", "section_slice"])
def test_no_window_over_the_rows_of_a_document(spark, name):
    """Windows run inside a block, or over block rows; never over a document's rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]\n", text)
    assert windows
    for partition, order in windows:
        assert "__block" in partition or "__block" in order

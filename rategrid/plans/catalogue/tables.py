"""Joins with layouts, combining states, CSV and partitioned outputs, faults."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rategrid import schemas
from rategrid.functions.text import split_lines
from rategrid.operators.bands import clean_salaries
from rategrid.operators.combine import combine_states, with_layouts
from rategrid.operators.faults import with_reason
from rategrid.operators.html_tables import html_tables
from rategrid.plans.registry import query, table
from rategrid.plans.inputs import award_docs, award_pages, order_words, salaries
from rategrid.sources.literal import literal_table
from rategrid.sources.readers import csv_rejects, read_csv, read_csv_checked, read_html_files, read_table
from rategrid.sources.sinks import shared_folder, write_by_state, write_csv


@query(
    "layout_join",
    r"""
    WITH l(state, start_pattern, start_offset, end_pattern, end_offset, skip_pattern) AS (VALUES
      ('NATION_1', 'PART B', 2, 'PART C', -2, '^\s+\d+$'),
      ('NATION_2', '', 0, '', 0, ''),
      ('NATION_3', NULL, NULL, NULL, NULL, NULL),
      ('Nation_4', 'never', 1, 'never', 1, ''))
    SELECT c_custkey AS doc_id, n_name AS state,
           start_pattern, start_offset, end_pattern, end_offset, skip_pattern
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN l ON state = n_name
    """,
)
def _layout_join(spark, sf_dir):
    layouts = literal_table(
        spark,
        [
            ("NATION_1", "PART B", 2, "PART C", -2, r"^\s+\d+$"),
            ("NATION_2", "", 0, "", 0, ""),
            ("NATION_3", None, None, None, None, None),
            ("Nation_4", "never", 1, "never", 1, ""),
        ],
        schemas.LAYOUTS,
    )
    return with_layouts(award_docs(spark, sf_dir), layouts)


@query(
    "csv_roundtrip",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal,
           CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')
                THEN c_mktsegment END AS pattern
    FROM customer
    """,
)
def _csv_roundtrip(spark, sf_dir):
    segment = F.col("c_mktsegment")
    # Three spellings of a missing pattern.
    pattern = (
        F.when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", F.lit(None).cast("string"))
        .when(segment == "FURNITURE", "NA")
        .otherwise(segment)
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", pattern.alias("pattern")
    )
    path = shared_folder(spark, "csv_roundtrip")
    write_csv(rows, path)
    return read_csv(spark, path, T.StructType(rows.schema.fields))


@query(
    "partitioned_sink",
    """
    SELECT n_name AS state, ' P-' || l_linenumber || ' ' AS level,
           l_extendedprice AS annual, l_linenumber AS band
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey
    """,
)
def _partitioned_sink(spark, sf_dir):
    path = shared_folder(spark, "partitioned_sink")
    write_by_state(clean_salaries(salaries(spark, sf_dir)), path)
    return spark.read.schema(schemas.SALARIES).parquet(path)


@query(
    "partitioned_one_state",
    """
    SELECT n_name AS state, ' P-' || l_linenumber || ' ' AS level,
           l_extendedprice AS annual, l_linenumber AS band
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey
    WHERE n_name = 'NATION_3'
    """,
)
def _partitioned_one_state(spark, sf_dir):
    # Only the folder of the state is read back.
    return _partitioned_sink(spark, sf_dir).where(F.col("state") == "NATION_3")


@query(
    "page_text_source",
    """
    SELECT CAST(o_custkey AS BIGINT) AS doc_id, o_orderkey + 1 AS page_no, 3 AS n_lines
    FROM orders
    UNION ALL SELECT c_custkey, 0, 5 FROM customer
    UNION ALL SELECT c_custkey, 1099511627776, 2 FROM customer
    """,
)
def _page_text_source(spark, sf_dir):
    path = shared_folder(spark, "page_text")
    award_pages(spark, sf_dir).write.mode("overwrite").parquet(path)
    pages = read_table(spark, path, schemas.PAGE_TEXT)
    return pages.select("doc_id", "page_no", F.size(split_lines(F.col("text"))).alias("n_lines"))


@query(
    "words_source",
    """
    SELECT c_custkey AS doc_id, CAST(length(CAST(c_custkey AS VARCHAR)) AS BIGINT) AS page_no,
           6 + CAST(coalesce(sum(CASE WHEN o_orderkey IS NOT NULL THEN
             3 + CASE WHEN o_orderpriority LIKE '% %' THEN 1 ELSE 0 END
               + CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'P' THEN 0 ELSE 1 END END), 0) AS BIGINT)
             AS n_words
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2
    """,
)
def _words_source(spark, sf_dir):
    path = shared_folder(spark, "words")
    order_words(spark, sf_dir).write.mode("overwrite").parquet(path)
    words = read_table(spark, path, schemas.WORDS)
    return words.groupBy("doc_id", "page_no").agg(F.count("text").alias("n_words"))


@query(
    "combine_states",
    """
    SELECT 'AGENCY' AS state, s_name AS level, s_acctbal AS annual, s_nationkey AS band,
           CAST(NULL AS VARCHAR) AS segment
    FROM supplier
    UNION ALL
    SELECT 'CLINIC', c_name, c_acctbal, NULL, c_mktsegment FROM customer
    """,
)
def _combine_states(spark, sf_dir):
    agency = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("level"), F.col("s_acctbal").alias("annual"),
        F.col("s_nationkey").alias("band"),
    )
    clinic = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("annual"), F.col("c_name").alias("level"),
        F.col("c_mktsegment").alias("segment"),
    )
    return combine_states({"AGENCY": agency, "CLINIC": clinic}).select(
        "state", "level", "annual", "band", "segment"
    )


@query(
    "fault_isolated",
    """
    SELECT CAST(event_id AS VARCHAR) AS key,
           CASE WHEN event_type NOT IN ('error', 'signup')
                THEN CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) END AS k,
           CASE event_type WHEN 'error' THEN 'no number' WHEN 'signup' THEN 'not a number: x'
             || regexp_extract(props, '(\\d+)', 1) END AS reason
    FROM events
    """,
)
def _fault_isolated(spark, sf_dir):
    # Two kinds of events come with broken properties.
    props = (
        F.when(F.col("event_type") == "error", F.lit("{}"))
        .when(F.col("event_type") == "signup", F.regexp_replace("props", r"(\d+)", "x$1"))
        .otherwise(F.col("props"))
    )
    found = F.regexp_extract(F.col("props"), r'"k":\s*([^}\s]+)', 1)
    events = (
        table(spark, sf_dir, "events").select("event_id", "event_type", props.alias("props"))
        .withColumn("found", found)
        .withColumn("k", F.col("found").try_cast("int"))
    )
    reason = F.when(F.col("found") == "", "no number").otherwise(
        F.concat(F.lit("not a number: "), F.col("found"))
    )
    checked = with_reason(events, F.col("k").isNull(), reason)
    return checked.select(F.col("event_id").cast("string").alias("key"), "k", "reason")


@query(
    "partitioned_rewrite",
    """
    SELECT n_name AS state, ' P-' || l_linenumber || ' ' AS level,
           CASE n_name WHEN 'NATION_3' THEN 2 * l_extendedprice ELSE l_extendedprice END AS annual,
           l_linenumber AS band
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey
    """,
)
def _partitioned_rewrite(spark, sf_dir):
    # All states are written, then one of them again.
    path = shared_folder(spark, "partitioned_rewrite")
    rows = clean_salaries(salaries(spark, sf_dir))
    write_by_state(rows, path)
    again = rows.where(F.col("state") == "NATION_3").withColumn("annual", 2 * F.col("annual"))
    write_by_state(again, path)
    return spark.read.schema(schemas.SALARIES).parquet(path)


def _write_lines(lines, path, parts=16, encoding=None):
    """Files of raw lines in the order ``ord``, one for each value of ``file``."""
    dealt = lines.repartition(parts, "file").sortWithinPartitions("file", "ord")
    writer = dealt.select("file", "line").write.mode("append").partitionBy("file")
    if encoding is None:
        writer.text(path)
    else:
        # The text writer knows UTF-8 only; a CSV of one column without quotes is the same.
        writer.options(encoding=encoding, quote="", sep="\u0001", ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False, emptyValue="").csv(path)


def _customer_csv(spark, sf_dir, name, header, record):
    """CSV files written by hand: customers in 16 files, each with the header."""
    path = shared_folder(spark, name)
    rows = table(spark, sf_dir, "customer").select(
        F.pmod("c_custkey", F.lit(16)).alias("file"), F.lit(1).alias("ord"), record.alias("line")
    )
    first = spark.range(16).select(F.col("id").alias("file"), F.lit(0).alias("ord"), F.lit(header).alias("line"))
    _write_lines(first.unionByName(rows), path)
    return path


_CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("said", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.StringType()),
])


def _quoted(*parts):
    return F.concat(F.lit('"'), F.replace(F.concat(*parts), F.lit('"'), F.lit('""')), F.lit('"'))


@query(
    "csv_quoted",
    """
    SELECT c_custkey, 'says "' || c_name || '", ' || chr(10) || 'twice' AS said, c_acctbal, c_mktsegment
    FROM customer
    """,
)
def _csv_quoted(spark, sf_dir):
    # Columns in another order than the schema's and one more; quotes, commas and line ends in cells.
    said = _quoted(F.lit('says "'), "c_name", F.lit('", \ntwice'))
    record = F.concat_ws(",", said, F.lit("more"), F.col("c_acctbal").cast("string"), F.col("c_mktsegment"), F.col("c_custkey").cast("string"))
    path = _customer_csv(spark, sf_dir, "csv_quoted", "said,other,C_ACCTBAL,c_mktsegment,c_custkey", record)
    return read_csv(spark, path, _CUSTOMER)


@query(
    "csv_rejects",
    """
    SELECT 'csv' AS stage,
           c_custkey || CASE c_custkey % 5 WHEN 1 THEN ',x,' || c_nationkey || 'k,' || c_mktsegment
             WHEN 2 THEN ',"a,b"' ELSE ',x,1,' || c_mktsegment || ',' || c_name END AS key,
           CASE c_custkey % 5 WHEN 1 THEN 'c_acctbal is no double: ' || c_nationkey || 'k'
             ELSE 'another number of cells than the header has' END AS reason
    FROM customer WHERE c_custkey % 5 BETWEEN 1 AND 3
    UNION ALL
    SELECT 'good', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_custkey % 5 IN (0, 4)
    """,
)
def _csv_rejects(spark, sf_dir):
    # Three records in five do not fit: no number, a cell too few, a cell too many.
    kind = F.col("c_custkey") % 5
    record = F.concat_ws(
        ",", F.col("c_custkey").cast("string"),
        F.when(kind == 1, F.concat(F.lit("x,"), F.col("c_nationkey"), F.lit("k,"), "c_mktsegment"))
        .when(kind == 2, '"a,b"').when(kind == 3, F.concat(F.lit("x,1,"), "c_mktsegment", F.lit(","), "c_name"))
        .otherwise(F.concat(F.lit("x, "), F.col("c_nationkey"), F.lit(" ,"), "c_mktsegment")),
    )
    path = _customer_csv(spark, sf_dir, "csv_rejects", "c_custkey,said,c_acctbal,c_mktsegment", record)
    checked = read_csv_checked(spark, path, _CUSTOMER)
    good = checked.where(F.col("reason").isNull()).select(
        F.lit("good").alias("stage"), F.col("c_custkey").cast("string").alias("key"),
        F.col("c_acctbal").cast("int").cast("string").alias("reason"),
    )
    return csv_rejects(checked).unionByName(good)


@query(
    "csv_exact",
    r"""
    SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NA'
             WHEN 3 THEN 'say "' || c_name || '"' WHEN 4 THEN c_name || ',' || c_mktsegment
             WHEN 5 THEN c_name || chr(13) || chr(10) || c_mktsegment || chr(13) WHEN 6 THEN ' ' || c_name || chr(9)
             WHEN 7 THEN '\"' || c_name || '\' ELSE '"' END AS said,
           CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def _csv_exact(spark, sf_dir):
    # What a sink writes its own reader reads back, missing values and empty texts apart.
    kind, name, segment = F.col("c_custkey") % 9, F.col("c_name"), F.col("c_mktsegment")
    said = (
        F.when(kind == 1, "").when(kind == 2, "NA").when(kind == 3, F.concat(F.lit('say "'), name, F.lit('"')))
        .when(kind == 4, F.concat(name, F.lit(","), segment))
        .when(kind == 5, F.concat(name, F.lit("\r\n"), segment, F.lit("\r")))
        .when(kind == 6, F.concat(F.lit(" "), name, F.lit("\t")))
        .when(kind == 7, F.concat(F.lit('\\"'), name, F.lit("\\"))).when(kind == 8, '"')
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", said.alias("said"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment",
    )
    path = shared_folder(spark, "csv_exact")
    write_csv(rows, path, exact=True)
    return read_csv(spark, path, _CUSTOMER, exact=True)


# Charsets of written files, and what their pages say of them; the last says nothing.
_CHARSETS = [("ISO-8859-1", '<meta charset="latin1">', "latin1"), ("UTF-16", "", "utf-16be"), ("UTF-8", "", "utf-8")]


@query(
    "html_files",
    """
    SELECT 'Höhe ' || s_name AS name, '£' || s_suppkey AS pay,
           CASE s_nationkey % 3 WHEN 0 THEN 'latin1' WHEN 1 THEN 'utf-16be' ELSE 'utf-8' END AS charset
    FROM supplier
    """,
)
def _html_files(spark, sf_dir):
    # A file for each nation and thousand suppliers, in three charsets.
    path = shared_folder(spark, "html_files")
    suppliers = table(spark, sf_dir, "supplier").withColumn(
        "file", F.concat_ws("-", "s_nationkey", F.floor(F.col("s_suppkey") / 1000))
    )
    line = F.concat(F.lit("<tr><td>Höhe "), "s_name", F.lit("</td><td>£"), "s_suppkey", F.lit("</td></tr>"))
    for i, (charset, meta, _) in enumerate(_CHARSETS):
        some = suppliers.where(F.col("s_nationkey") % 3 == i)
        rows = some.select("file", F.lit(1).alias("ord"), line.alias("line"))
        files = some.select("file").distinct()
        ends = files.select("file", F.inline(F.array(
            F.struct(F.lit(0).alias("ord"), F.lit(f"<html><head>{meta}</head><table>").alias("line")),
            F.struct(F.lit(2).alias("ord"), F.lit("</table></html>").alias("line")),
        )))
        _write_lines(ends.unionByName(rows), path, encoding=charset)
    read = html_tables(read_html_files(spark, path))
    rows = read.select("charset", F.explode(F.flatten("tables")).alias("cells"))
    return rows.select(F.get("cells", F.lit(0)).alias("name"), F.get("cells", F.lit(1)).alias("pay"), "charset")

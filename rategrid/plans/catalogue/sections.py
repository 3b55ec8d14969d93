"""Lines, sections and checks of text documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rategrid.functions.arrays import inlined
from rategrid.functions.text import (
    drop_blank,
    drop_matching,
    last_match,
    numbered,
    split_lines,
)
from rategrid.operators.extract import extract_tables
from rategrid.operators.sections import (
    after_head,
    cut_pages,
    cut_text,
    head,
    last_matching_line,
    layout_literals,
    page_lines,
    pages_matching,
    section_rejects,
    section_rows,
    text_check,
    without_blank,
    without_matching,
    without_repeats,
    without_repeats_in,
)
from rategrid.plans.registry import query, table
from rategrid import schemas
from rategrid.operators.combine import with_layouts
from rategrid.plans.inputs import award_doc_layouts, award_docs, award_pages, part_pages
from rategrid.sources.literal import literal_table

# A word looked for in documents of each language.
WORDS = {"en": " the ", "fr": " les ", "de": " und ", "es": " que "}
_WORD_SQL = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in WORDS.items()) + " END"
_LINES = """
    l AS (SELECT doc_id, lang, string_split(text, chr(10)) AS ls FROM documents),
    lines AS (
      SELECT doc_id, lang, len(ls) AS n, unnest(range(1, len(ls) + 1)) AS line_no,
             unnest(ls) AS line FROM l)
"""
_TURN_LINES = """
    t AS (SELECT conv_id AS doc_id, turn, string_split(text, chr(10)) AS ls FROM conversations),
    p AS (SELECT doc_id, turn, ls,
                 coalesce(sum(len(ls)) OVER (PARTITION BY doc_id ORDER BY turn
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t),
    lines AS (
      SELECT doc_id, turn, CAST(before + unnest(range(1, len(ls) + 1)) AS BIGINT) AS line_no,
             unnest(ls) AS line FROM p)
"""


def _word():
    pattern = F.lit(None).cast("string")
    for lang, word in WORDS.items():
        pattern = F.when(F.col("lang") == lang, word).otherwise(pattern)
    return pattern


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text")


def _document_rows(spark, sf_dir, text=None):
    docs = _documents(spark, sf_dir)
    rows = numbered(split_lines(F.col("text") if text is None else text))
    return docs.select("doc_id", "lang", rows.alias("rows"))


def _turn_pages(spark, sf_dir):
    """Conversations as paged documents: a turn is a page."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text"
    )


@query("doc_lines", f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines")
def _doc_lines(spark, sf_dir):
    return inlined(_document_rows(spark, sf_dir), ["doc_id"], "rows", "line_no")


@query("doc_lines_paged", f"WITH {_TURN_LINES} SELECT doc_id, line_no, line FROM lines")
def _doc_lines_paged(spark, sf_dir):
    return page_lines(_turn_pages(spark, sf_dir))


@query(
    "last_match",
    f"""
    WITH {_LINES}
    SELECT doc_id, CAST(max(line_no) FILTER (regexp_matches(line, {_WORD_SQL})) AS INTEGER)
             AS last_line
    FROM lines GROUP BY doc_id
    """,
)
def _last_match(spark, sf_dir):
    hit = last_match(split_lines(F.col("text")), _word())
    return _documents(spark, sf_dir).select("doc_id", hit.alias("last_line"))


@query(
    "last_match_paged",
    f"""
    WITH {_TURN_LINES}
    SELECT doc_id, max(line_no) FILTER (regexp_matches(line, '^The |^Le |^Der ')) AS last_line
    FROM lines GROUP BY doc_id
    """,
)
def _last_match_paged(spark, sf_dir):
    return last_matching_line(page_lines(_turn_pages(spark, sf_dir)), "^The |^Le |^Der ")


# Documents cut from the line after the last one with the language's word to the
# last line but one, without lines that start with A to D.
_TEXT_SPANS = f"""
    {_LINES},
    spans AS (
      SELECT doc_id, any_value(n) - 1 AS last,
             max(line_no) FILTER (regexp_matches(line, {_WORD_SQL})) + 1 AS first
      FROM lines GROUP BY doc_id)
"""


def _cut_documents(spark, sf_dir):
    layout = {**layout_literals("", 1, "", -1, "^[A-D]"), "start_pattern": _word()}
    return cut_text(_documents(spark, sf_dir), layout)


@query(
    "section_text",
    f"""
    WITH {_TEXT_SPANS}
    SELECT doc_id, line_no, line FROM lines JOIN spans USING (doc_id)
    WHERE line_no BETWEEN first AND last
      AND NOT regexp_matches(line, '^[A-D]') AND NOT regexp_matches(line, '^\\s*$')
    """,
)
def _section_text(spark, sf_dir):
    return section_rows(_cut_documents(spark, sf_dir))


@query(
    "section_text_rejects",
    f"""
    WITH {_TEXT_SPANS}
    SELECT 'section' AS stage, CAST(doc_id AS VARCHAR) AS key,
           CASE WHEN first IS NULL THEN 'no_start' ELSE 'end_before_start' END AS reason
    FROM spans WHERE first IS NULL OR last < first
    """,
)
def _section_text_rejects(spark, sf_dir):
    return section_rejects(_cut_documents(spark, sf_dir))


@query(
    "section_slice",
    """
    WITH r AS (
      SELECT o_custkey AS doc_id, c_nationkey AS nation, o_orderkey,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k,
             '  ' || o_orderpriority || '  ' || o_orderstatus || '  $'
               || format('{:,.2f}', o_totalprice) AS line
      FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT doc_id, 3 * k + 3 AS line_no, line FROM r WHERE nation <= 17 OR nation = 23
    """,
)
def _section_slice(spark, sf_dir):
    return cut_pages(award_pages(spark, sf_dir), award_doc_layouts(spark, sf_dir))[0]


@query(
    "section_rejects",
    """
    SELECT 'section' AS stage, CAST(c_custkey AS VARCHAR) AS key,
           CASE WHEN c_nationkey IN (18, 19, 24) THEN 'no_layout'
                WHEN c_nationkey = 20 THEN 'no_start'
                WHEN c_nationkey = 21 THEN 'no_end' ELSE 'end_before_start' END AS reason
    FROM customer
    WHERE c_nationkey IN (18, 19, 20, 21, 22, 24)
       OR c_custkey NOT IN (SELECT o_custkey FROM orders)
    """,
)
def _section_rejects(spark, sf_dir):
    return cut_pages(award_pages(spark, sf_dir), award_doc_layouts(spark, sf_dir))[1]


@query(
    "skip_lines",
    f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines "
    f"WHERE NOT regexp_matches(line, {_WORD_SQL})",
)
def _skip_lines(spark, sf_dir):
    rows = _document_rows(spark, sf_dir).withColumn("rows", drop_matching(F.col("rows"), _word()))
    return inlined(rows, ["doc_id"], "rows", "line_no")


@query(
    "skip_lines_paged",
    f"WITH {_TURN_LINES} SELECT doc_id, line_no, line FROM lines "
    "WHERE NOT regexp_matches(line, '^The |^Le |^Der ')",
)
def _skip_lines_paged(spark, sf_dir):
    return without_matching(page_lines(_turn_pages(spark, sf_dir)), "^The |^Le |^Der ")


@query(
    "skip_blank",
    f"""
    WITH {_LINES}
    SELECT doc_id, 2 * line_no - 1 AS line_no, line FROM lines
    WHERE NOT regexp_matches(line, '^\\s*$')
    """,
)
def _skip_blank(spark, sf_dir):
    # A line of blanks after every line but the last.
    spaced = F.replace(F.col("text"), F.lit("\n"), F.lit("\n \t \n"))
    rows = _document_rows(spark, sf_dir, spaced).withColumn("rows", drop_blank(F.col("rows")))
    return inlined(rows, ["doc_id"], "rows", "line_no")


@query(
    "skip_blank_paged",
    f"""
    WITH {_TURN_LINES}
    SELECT doc_id, line_no, trim(line) AS line FROM lines
    WHERE NOT regexp_matches(line, '^\\s*$')
    """,
)
def _skip_blank_paged(spark, sf_dir):
    return without_blank(page_lines(_turn_pages(spark, sf_dir)), trim=True)


@query(
    "repeat_headers",
    f"""
    WITH {_LINES}
    SELECT doc_id, 2 * line_no - 1 AS line_no, line FROM lines
    UNION ALL SELECT doc_id, 2, 'CLASSIFICATION  PAY' FROM lines WHERE line_no = 1 AND n > 1
    """,
)
def _repeat_headers(spark, sf_dir):
    # A heading after every line but the last.
    headed = F.replace(F.col("text"), F.lit("\n"), F.lit("\nCLASSIFICATION  PAY\n"))
    rows = without_repeats_in(
        _document_rows(spark, sf_dir, headed), "rows", "^CLASSIFICATION"
    )
    return inlined(rows, ["doc_id"], "rows", "line_no")


@query(
    "repeat_headers_paged",
    f"""
    WITH {_TURN_LINES},
    m AS (SELECT *, regexp_matches(line, '^(The|Le|La|Der|Die) ') AS hit FROM lines)
    SELECT doc_id, line_no, line FROM m WHERE NOT hit
    UNION ALL
    SELECT doc_id, min(line_no), arg_min(line, line_no) FROM m WHERE hit GROUP BY doc_id
    """,
)
def _repeat_headers_paged(spark, sf_dir):
    return without_repeats(page_lines(_turn_pages(spark, sf_dir)), "^(The|Le|La|Der|Die) ")


@query(
    "repeat_headers_null_key",
    f"""
    WITH {_TURN_LINES},
    m AS (SELECT * REPLACE (CASE WHEN doc_id % 3 > 0 THEN doc_id END AS doc_id,
                            CASE WHEN doc_id % 3 > 0 THEN line_no
                                 ELSE 1000 * doc_id + line_no END AS line_no),
                 regexp_matches(line, '^(The|Le|La|Der|Die) ') AS hit FROM lines)
    SELECT doc_id, line_no, line FROM m WHERE NOT hit
    UNION ALL
    SELECT doc_id, min(line_no), arg_min(line, line_no) FROM m WHERE hit GROUP BY doc_id
    """,
)
def _repeat_headers_null_key(spark, sf_dir):
    # A third of the documents have lost their key: their lines are one document.
    lines, known = page_lines(_turn_pages(spark, sf_dir)), F.col("doc_id") % 3 > 0
    lines = lines.withColumn(
        "line_no", F.when(known, F.col("line_no")).otherwise(1000 * F.col("doc_id") + F.col("line_no"))
    ).withColumn("doc_id", F.when(known, F.col("doc_id")))
    return without_repeats(lines, "^(The|Le|La|Der|Die) ")


@query(
    "skip_lines_nbsp",
    f"""
    WITH {_LINES}
    SELECT doc_id, 2 * line_no - 1 AS line_no, line FROM lines
    """,
)
def _skip_lines_nbsp(spark, sf_dir):
    # A page number after every line but the last, set in with no-break blanks.
    paged = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\u00a0\u00a012\n"))
    rows = _document_rows(spark, sf_dir, paged)
    kept = rows.withColumn("rows", drop_matching(F.col("rows"), F.lit(r"^\s+\d+$")))
    return inlined(kept, ["doc_id"], "rows", "line_no")


@query(
    "page_subset",
    """
    WITH t AS (
      SELECT conv_id AS doc_id, turn AS page_no, string_split(text, chr(10)) AS ls
      FROM conversations WHERE regexp_matches(text, ' (les|the) '))
    SELECT doc_id, page_no, unnest(range(1, len(ls) + 1)) AS line_no, unnest(ls) AS line FROM t
    """,
)
def _page_subset(spark, sf_dir):
    pages = pages_matching(_turn_pages(spark, sf_dir), " (les|the) ")
    rows = numbered(split_lines(F.col("text")))
    return inlined(pages, ["doc_id", "page_no"], rows, "line_no")


@query("skip_head", f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines WHERE line_no > 3")
def _skip_head(spark, sf_dir):
    rows = _document_rows(spark, sf_dir).withColumn("rows", after_head(F.col("rows"), 3))
    return inlined(rows, ["doc_id"], "rows", "line_no")


@query("head_lines", f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines WHERE line_no <= 21")
def _head_lines(spark, sf_dir):
    rows = _document_rows(spark, sf_dir).withColumn("rows", head(F.col("rows"), 21))
    return inlined(rows, ["doc_id"], "rows", "line_no")


@query(
    "has_text",
    """
    SELECT conv_id AS doc_id, bool_or(length(text) > 15) AS has_text, count(*) AS pages_read,
           count(*) = 5 AS complete
    FROM conversations GROUP BY conv_id
    UNION ALL
    SELECT -1 - doc_id, length(text) > 15, 1, true FROM documents
    """,
)
def _has_text(spark, sf_dir):
    turns = _turn_pages(spark, sf_dir).withColumn("pages_expected", F.lit(5))
    single = _documents(spark, sf_dir).select((-1 - F.col("doc_id")).alias("doc_id"), "text")
    return text_check(turns).unionByName(text_check(single))


@query(
    "dispatch_doc_type",
    """
    WITH d AS (
      SELECT p_partkey AS doc_id, p_type, p_name, p_brand, CAST(p_size AS VARCHAR) AS size
      FROM part),
    h AS (
      SELECT doc_id, 'html' AS route, unnest([0, 1, 2]) AS row_no,
             unnest(['Field', 'name', 'type & size']) AS c0,
             unnest(['Value', p_name, p_type]) AS c1, unnest(['Value', p_brand, size]) AS c2
      FROM d WHERE p_type IN ('ECONOMY', 'SMALL')),
    t AS (
      SELECT doc_id, 'pdf' AS route, unnest([2, 3]) AS row_no, unnest([p_name, 'size']) AS c0,
             unnest([p_brand, size]) AS c1, CAST(NULL AS VARCHAR) AS c2
      FROM d WHERE p_type IN ('STANDARD', 'MEDIUM'))
    SELECT CAST(doc_id AS VARCHAR) AS key, route, CAST(row_no AS BIGINT) AS row_no, c0, c1, c2,
           CAST(NULL AS VARCHAR) AS reason FROM h
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), route, row_no, c0, c1, c2, NULL FROM t
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 'doc_type', NULL, NULL, NULL, NULL,
           CASE p_type WHEN 'LARGE' THEN 'scanned document' ELSE 'unknown type: docx' END
    FROM d WHERE p_type IN ('LARGE', 'PROMO')
    """,
)
def _dispatch_doc_type(spark, sf_dir):
    kind = (
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), "html")
        .when(F.col("p_type").isin("STANDARD", "MEDIUM"), "pdf")
        .when(F.col("p_type") == "LARGE", "scan.pdf")
        .otherwise("docx")
    )
    text = F.concat_ws(
        "\n", F.lit("RATES"), F.concat_ws("  ", "p_name", "p_brand"),
        F.concat_ws("   ", F.lit("size"), "p_size"), F.lit("END"),
    )
    pages = part_pages(spark, sf_dir, kind.alias("doc_type"), text.alias("text"))
    docs = pages.withColumn("order", F.lit("fwd"))
    extracted = extract_tables(docs, layout_literals("^RATES", 1, "^END", -1, ""))
    return extracted.select(
        F.col("doc_id").cast("string").alias("key"),
        F.coalesce("route", F.lit("doc_type")).alias("route"),
        "reason",
        F.explode_outer("rows").alias("row"),
    ).select(
        "key", "route", "row.row_no",
        *[F.get("row.cells", F.lit(i)).alias(f"c{i}") for i in range(3)],
        "reason",
    )


@query(
    "section_bad_patterns",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN n_nationkey % 5 IN (0, 4) THEN
             CASE WHEN count(o_orderkey) > 0 THEN count(o_orderkey) END END AS n_lines,
           CASE n_nationkey % 5 WHEN 1 THEN 'bad_start_pattern' WHEN 2 THEN 'bad_end_pattern'
             WHEN 3 THEN 'bad_skip_pattern'
             ELSE CASE WHEN count(o_orderkey) = 0 THEN 'end_before_start' END END AS reason
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, n_nationkey
    """,
)
def _section_bad_patterns(spark, sf_dir):
    # Layouts of three states in five hold a pattern that does not compile.
    good = ["PART B", 2, "PART C", -1, r"^\s+\d+$"]
    kinds = [good, ["(", *good[1:]], [*good[:2], "[", *good[3:]], [*good[:4], "*"], good]
    layouts = literal_table(spark, [(f"NATION_{i}", *kinds[i % 5]) for i in range(25)], schemas.LAYOUTS)
    docs = with_layouts(award_docs(spark, sf_dir), layouts)
    lines, rejected = cut_pages(award_pages(spark, sf_dir), docs)
    kept = lines.groupBy(F.col("doc_id").cast("string").alias("key")).agg(F.count("line").alias("n_lines"))
    return kept.select("key", "n_lines", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("key", F.lit(None).cast("bigint").alias("n_lines"), "reason")
    )

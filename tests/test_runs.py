"""The three stages after one another, in batches and on a stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rategrid import schemas
from rategrid.operators.combine import with_layouts
from rategrid.plans.award_run import (
    acquire,
    analyse,
    analyse_checked,
    bands_of,
    extract,
    extract_any,
    extract_checked,
    rejects_of,
)
from rategrid.sources.literal import literal_table
from rategrid.sources.readers import read_csv
from rategrid.sources.sinks import write_csv
from rategrid.streaming.watch import (
    arriving_salaries,
    arriving_sections,
    band_updates,
    keep_bands,
)

INDEX = '<a href="/2020/Award.pdf">old</a><a href="/2022/Award.pdf">new</a>'
AWARD = [
    "Contents\nPART B ... 2\nPART C ... 3",
    "Preamble\nPART B\nSalary rates\n  P-1  Per Year   $78,909\n  P-2  Per Year  $83,651\n   2",
    "\n  P-1  Per Year   $88,174\n  P-9  Per Year  $1\nPART C\nSignatures",
]


def test_award_run(spark, frame, tmp_path):
    sources = frame(
        [("NSW", "https://h/i", "IDX", "Award", "fwd", "pdf"),
         ("QLD", "https://h/q", "WEB", "", "fwd", "HTML"),
         ("SA", "https://h/i", "IDX", "Award", "newest", "scan.pdf")],
        "state string, url string, type string, pattern string, order string, doc_type string")
    pages = frame([("https://h/i", INDEX)], "url string, html string")
    registry, rejected = acquire(sources, pages, "awards")
    path = str(tmp_path / "registry")
    write_csv(registry.select(
        *[F.col(f.name) if f.name in registry.columns else F.lit(None).cast("string").alias(f.name)
          for f in schemas.SOURCES_AND_FILE.fields]), path)
    back = read_csv(spark, path, schemas.SOURCES_AND_FILE)
    found = {r.state: (r.doc_url, r.award_file, r.pattern) for r in back.collect()}
    assert found == {
        "NSW": ("https://h/2022/Award.pdf", "awards/NSW.pdf", "Award"),
        "QLD": ("https://h/q", "awards/QLD.html", None)}
    assert [r.key for r in rejected.collect()] == ["SA"]

    layouts = literal_table(
        spark, [("NSW", "^PART B", 2, "^PART C", -1, r"^\s+\d+$")], schemas.LAYOUTS)
    docs = with_layouts(frame([(1, "NSW"), (2, "QLD")], "doc_id bigint, state string"), layouts)
    text = frame([(1, i, t) for i, t in enumerate(AWARD, 1)] + [(2, 1, "x")],
                 "doc_id bigint, page_no bigint, text string")
    rows, rejected = extract(
        text, docs, level=F.get("cells", F.lit(1)), amount=F.get("cells", F.lit(3)))
    assert sorted((r.line_no, r.level, r.annual) for r in rows.collect()) == [
        (7, "P-1", 78909.0), (8, "P-2", 83651.0), (11, "P-1", 88174.0), (12, "P-9", 1.0)]
    assert [(r.key, r.reason) for r in rejected.collect()] == [("2", "no_layout")]

    crosswalk = frame([("NSW", "P-1", 1), ("NSW", "P-2", 1)],
                      "state string, level string, band int")
    bands, rejected = analyse(rows, docs, crosswalk)
    assert [tuple(r) for r in bands.collect()] == [("NSW", 1, 78909.0, 88174.0)]
    assert [r.key for r in rejected.collect()] == ["NSW/P-9"]


@pytest.mark.parametrize("na", ["propagate", "ignore"])
def test_bands_of_arriving_files(spark, tmp_path, na):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    updates = band_updates(arriving_salaries(spark, str(folder), files_per_batch=1), na)
    files = ['WA,P-1," $10 ",1\nWA,P-2," $30 ",1\n', 'WA,P-1," $5 ",1\nWA,P-1,by agreement,2\n']
    for i, rows in enumerate(files):
        (folder / f"{i}.csv").write_text("state,level,annual,band\n" + rows)
        keep_bands(updates, out, str(tmp_path / "checkpoint")).awaitTermination(120)
    last = spark.read.parquet(f"{out}/batch=1")
    found = sorted((r.state, r.band, r.lo, r.hi) for r in last.collect())
    assert found == [("WA", 1, 5.0, 30.0), ("WA", 2, None, None)]


def test_sections_of_arriving_documents(spark, frame, tmp_path):
    folder = str(tmp_path / "docs")
    docs = frame([("NSW", 1, "PART B\nx\n a  1\nPART C"), ("SA", 2, "y")],
                 "state string, doc_id bigint, text string")
    docs.write.parquet(folder)
    layouts = literal_table(spark, [("NSW", "PART B", 2, "PART C", -1, "")], schemas.LAYOUTS)
    stream = arriving_sections(spark.readStream.schema(docs.schema).parquet(folder), layouts)
    query = stream.writeStream.format("memory").queryName("sections").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [tuple(r) for r in spark.table("sections").collect()] == [(1, 3, " a  1")]


def test_rows_and_rejects_of_all_types_in_one_frame(frame):
    layout = ("^PART B", 2, "^PART C", -1, r"^\s+\d+$")
    none = (None, None, None, None, None)
    docs = frame([
        (1, "NSW", "pdf", *layout), (2, "NSW", "PDF", *none), (3, "QLD", "html", *none), (4, "QLD", "html", *none),
        (5, "WA", "scan.pdf", *none), (6, "WA", "docx", *none), (7, "WA", "pdf", *layout), (8, "WA", "html", *none),
        (9, "WA", "html", *layout), (10, "WA", "pdf", "(", 1, "x", 1, ""), (11, "SA", "pdf", "^PART B", 1, "^PART C", -1, ""),
    ], "doc_id bigint, state string, doc_type string, start_pattern string, start_offset int, end_pattern string, "
       "end_offset int, skip_pattern string")
    pages = frame(
        [(1, i, t) for i, t in enumerate(AWARD, 1)]
        + [(2, 1, "x"), (9, 1, AWARD[1]), (10, 1, "x"), (99, 1, "y"), (11, 1, "PART B\n \nPART C")],
        "doc_id bigint, page_no bigint, text string")
    row = "<tr><td>%s</td><td>%s</td></tr>"
    table = "<table>" + row % ("P-1", "$50") + row % ("P-2", "n/a") + row % ("P-9", "$1") + "</table>"
    html = frame([(3, table, "fwd"), (4, "<p>", "fwd"), (9, table, "up"), (98, table, "fwd"), (1, table, "fwd")],
                 "doc_id bigint, html string, order string")
    cell = lambda i: F.get("cells", F.lit(i))
    picks = (cell(1), cell(3)), (cell(0), cell(1))
    crosswalk = frame([("NSW", "P-1", 1), ("NSW", "P-2", 1), ("NSW", "P-9", 3), ("QLD", "P-1", 1), ("QLD", "P-2", 2)],
                      "state string, level string, band int")
    checked = analyse_checked(extract_checked(docs, pages, html, *picks), docs, crosswalk)
    bands = sorted(tuple(r) for r in bands_of(checked).collect())
    assert bands == [("NSW", 1, 78909.0, 88174.0), ("NSW", 3, 1.0, 1.0), ("QLD", 1, 50.0, 50.0), ("QLD", 2, None, None)]
    found = sorted(tuple(r) for r in rejects_of(checked).collect())
    assert found == sorted([
        ("section", "2", "no_layout"), ("html", "4", "no table"), ("doc_type", "5", "scanned document"),
        ("doc_type", "6", "unknown type: docx"), ("section", "7", "no text"), ("html", "8", "no text"),
        ("html", "9", "bad order"), ("section", "10", "bad_start_pattern"), ("section", "99", "unknown document"),
        ("html", "98", "unknown document"), ("crosswalk", "QLD/P-9", "no band"),
    ])
    # The same from rows and rejects apart.
    rows, rejected = extract_any(docs, pages, html, *picks)
    apart, more = analyse(rows, docs, crosswalk)
    assert sorted(tuple(r) for r in apart.collect()) == bands
    assert sorted(tuple(r) for r in rejected.unionByName(more).collect()) == found

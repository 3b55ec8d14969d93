from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rategrid import schemas
from rategrid.operators.faults import rejects, with_reason, worked
from rategrid.sources.literal import literal_table
from rategrid.sources.readers import read_csv, read_table
from rategrid.sources.sinks import shared_folder, write_by_state, write_csv


def test_missing_values_survive_csv(spark, frame, tmp_path):
    rows = frame([("QLD", "", 1), ("WA", None, 2), ("SA", "NA", None), ("TAS", " a,b \"c\" ", 4)],
                 "state string, pattern string, n int")
    path = str(tmp_path / "out")
    write_csv(rows, path)
    found = {r.state: (r.pattern, r.n) for r in read_csv(spark, path, rows.schema).collect()}
    assert found["QLD"] == (None, 1) and found["WA"] == (None, 2) and found["SA"] == (None, None)
    assert found["TAS"][0].strip() == 'a,b "c"'
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert "WA,NA,2" in text


def test_sources_with_quoted_empty_pattern(spark, tmp_path):
    path = tmp_path / "sources.csv"
    path.write_text(
        "state,url,type,pattern,order,doc_type,notes,doc_url\n"
        'QLD,https://h/p,WEB,"",fwd,html,salaries are in web page,https://h/p\n'
        "WA,https://h/i,IDX,Salaried,fwd,pdf,text PDF,NA\n")
    rows = {r.state: r for r in read_csv(spark, str(path), schemas.SOURCES).collect()}
    assert rows["QLD"].pattern is None and rows["WA"].pattern == "Salaried"
    assert rows["WA"].doc_url is None


def test_partitions_by_state(spark, frame, tmp_path):
    rows = frame([(s, f"L{i}", float(i), i % 3) for i in range(40) for s in ("WA", "NSW")],
                 "state string, level string, annual double, band int")
    path = str(tmp_path / "by_state")
    write_by_state(rows, path)
    back = spark.read.schema(schemas.SALARIES).parquet(path)
    assert back.count() == 80
    one = back.where("state = 'WA'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 40 and "PartitionFilters: [isnotnull(state" in plan


def test_shared_folder_follows_the_cluster_setting(spark):
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(root) and "/x-" in first


def test_read_table_checks_columns(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame([(1, 2, "x")], "doc_id int, page_no int, text string").write.parquet(path)
    assert read_table(spark, path, schemas.PAGE_TEXT).schema == schemas.PAGE_TEXT
    with pytest.raises(ValueError, match="space"):
        read_table(spark, path, schemas.WORDS)


def test_literal_table_has_a_known_size(spark):
    empty = literal_table(spark, [], schemas.LAYOUTS)
    assert empty.count() == 0 and empty.schema == schemas.LAYOUTS
    plan = literal_table(spark, [("A", None, None, None, None, "")], schemas.LAYOUTS)
    assert "LocalTableScan" in plan._jdf.queryExecution().executedPlan().toString()


def test_one_bad_row_does_not_stop_the_others(frame):
    rows = frame([(1, "4"), (2, "x"), (3, None), (9007199254740993, "7")], "id bigint, v string")
    number = F.col("v").try_cast("int")
    checked = with_reason(rows, number.isNull(), F.lit("no number"))
    assert sorted(r.id for r in worked(checked).collect()) == [1, 9007199254740993]
    assert sorted(tuple(r) for r in rejects(checked, "parse", F.col("id")).collect()) == [
        ("parse", "2", "no number"), ("parse", "3", "no number")]

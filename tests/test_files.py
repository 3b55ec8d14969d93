"""CSV as RFC 4180 has it, states written again, HTML of any encoding."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rategrid.functions.charsets import decoded
from rategrid.sources.readers import (
    csv_headers,
    csv_rejects,
    read_csv,
    read_csv_checked,
    read_html_files,
)
from rategrid.sources.sinks import shared_folder, write_by_state, write_csv



def table(**kinds):
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


SCHEMA = table(a=T.IntegerType(), b=T.DoubleType(), c=T.StringType(), d=T.DateType())
FEW = "another number of cells than the header has"


def put(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_columns_by_name_quotes_and_line_ends(spark, tmp_path):
    put(tmp_path / "a.csv", '\ufeffC, a ,x,b\n"say ""hi"", ok",1,z,2.5\n"two\nlines",2,,NA\n"",3,q,-1e3\n " pad " ,4,,\n')
    found = read_csv(spark, str(tmp_path), SCHEMA).collect()
    assert [tuple(r) for r in found] == [
        (1, 2.5, 'say "hi", ok', None), (2, None, "two\nlines", None), (3, -1000.0, None, None), (4, None, " pad ", None)]


def test_records_that_do_not_fit(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'a,b,c,d\r\n1,x,"y,z",2020-01-02\r\n2,1\r\n3,1,p,2020-02-30\r\n4,1,p,2020-02-03,more\r\n'
                                   '"5x",y,p,NA\r\n,,,\r\n7,7,"\r\n",NA\r\n')
    checked = read_csv_checked(spark, path, SCHEMA)
    rows = {r.record.split(",")[0]: (r.a, r.b, r.reason) for r in checked.collect()}
    assert rows == {
        "1": (1, None, "b is no double: x"), "2": (2, 1.0, FEW), "3": (3, 1.0, "d is no date: 2020-02-30"),
        "4": (4, 1.0, FEW), "5x": (None, None, "a is no int: 5x"), "": (None, None, None), "7": (7, 7.0, None)}
    bad = csv_rejects(checked)
    assert bad.count() == 5 and sorted(r.reason for r in bad.collect()) == sorted(
        r for _, _, r in rows.values() if r)
    assert {tuple(r) for r in bad.select("stage", "key").collect()} >= {("csv", "2,1"), ("csv", "4,1,p,2020-02-03,more")}
    assert read_csv(spark, path, SCHEMA).count() == 5


def test_only_text_columns_can_be_counted(spark, tmp_path):
    path = put(tmp_path / "a.csv", "c,e\nx,y\nz\n")
    checked = read_csv_checked(spark, path, table(c=T.StringType()))
    assert csv_rejects(checked).count() == 1 and csv_rejects(checked).select("reason").collect()[0].reason == FEW


def test_files_of_other_headers(spark, tmp_path):
    put(tmp_path / "1.csv", "a,c\n1,x\n")
    put(tmp_path / "2.csv", 'c,b,a\n"y\nz",2,2\n')
    put(tmp_path / "3.csv", "a,c\n3,w\n")
    headers = csv_headers(spark, str(tmp_path))
    assert {k: len(v) for k, v in headers.items()} == {("a", "c"): 2, ("c", "b", "a"): 1}
    found = read_csv(spark, str(tmp_path), SCHEMA, each_header=True).collect()
    assert sorted(tuple(r) for r in found) == [(1, None, "x", None), (2, 2.0, "y\nz", None), (3, None, "w", None)]
    with pytest.raises(Exception, match="error while reading file"):
        read_csv(spark, str(tmp_path), SCHEMA).collect()


def test_odd_headers(spark, tmp_path):
    twice = put(tmp_path / "1.csv", "a,a,,c\n1,2,3,x\n")
    assert [tuple(r) for r in read_csv(spark, twice, SCHEMA, each_header=True).collect()] == [(1, None, "x", None)]
    only = put(tmp_path / "2.csv", "a,c\n")
    assert read_csv(spark, only, SCHEMA).count() == 0
    empty = tmp_path / "none"
    empty.mkdir()
    put(empty / "x.csv", "")
    assert read_csv(spark, str(empty), SCHEMA).collect() == []


def test_encoding_and_lines(spark, tmp_path):
    path = put(tmp_path / "1.csv", "c,a\nHöhe,1\n\"x,2\n", "iso-8859-1")
    found = read_csv(spark, path, SCHEMA, encoding="ISO-8859-1", lines_in_cells=False).collect()
    assert found[0].c == "Höhe" and len(found) >= 1


TEXTS = ['say "hi"', "a,b", "x\r\ny", "x\ry", None, "", "NA", " pad ", "\\", 'a\\"b', '"', "#c", "\n", "\ta", "é ", "null", '""', ",", "a\\"]


@pytest.mark.parametrize("exact", [True, False])
def test_round_trip(spark, frame, tmp_path, exact):
    schema = "id int, t string, b boolean, x double, d date, s timestamp_ntz"
    rows = frame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string").selectExpr(
        "id", "t", "id % 2 = 0 AS b", "if(id % 3 = 0, null, id / 7) AS x", "date_add(date'2020-01-01', id) AS d",
        "timestamp_ntz'2020-01-01 10:00:00.5' AS s")
    path = str(tmp_path / "o")
    write_csv(rows, path, exact=exact)
    back = read_csv(spark, path, T.StructType.fromDDL(schema), exact=exact)
    wanted = {r.id: tuple(r) for r in rows.collect()}
    if not exact:
        lost = {t: None for t in ("", "NA")} | {" pad ": "pad", "\ta": "a"}
        wanted = {k: (k, lost.get(v[1], v[1]), *v[2:]) for k, v in wanted.items()}
    assert {r.id: tuple(r) for r in back.collect()} == wanted


def test_states_written_again(spark, frame, tmp_path):
    schema, path = "state string, band int, lo double", str(tmp_path / "s")
    write_by_state(frame([("WA", 1, 1.0), ("SA", 1, 2.0), ("NT", 1, 3.0), (None, 1, 4.0)], schema), path)
    write_by_state(frame([("WA", 2, 9.0), ("QLD", 1, 5.0)], schema), path)
    back = lambda: sorted((tuple(r) for r in spark.read.schema(schema).parquet(path).select("state", "band", "lo").collect()), key=repr)
    assert back() == sorted([("WA", 2, 9.0), ("SA", 1, 2.0), ("NT", 1, 3.0), (None, 1, 4.0), ("QLD", 1, 5.0)], key=repr)
    write_by_state(frame([], schema), path)
    assert len(back()) == 5
    broken = frame([("SA", 1, 0.0)], schema).withColumn("lo", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_by_state(broken, path)
    assert ("SA", 1, 2.0) in back()
    write_by_state(frame([("ACT", 1, 7.0)], schema), path, whole=True)
    assert back() == [("ACT", 1, 7.0)]


class Cluster:
    """A session as it looks on a cluster that names no shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

    class conf:  # noqa: N801
        @staticmethod
        def get(name, default=None):
            return default


def test_no_folder_of_ones_own_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster, "x")


PAGE = "<html><head><meta charset='{}'></head><p>Höhe £5 – “pay”</p>"


@pytest.mark.parametrize(("content", "text", "charset"), [
    ("Höhe £5".encode(), "Höhe £5", "utf-8"),
    (b"\xef\xbb\xbfH\xc3\xb6he", "Höhe", "utf-8"),
    ("\ufeffHöhe – 工".encode("utf-16-le"), "Höhe – 工", "utf-16le"),
    ("\ufeffHöhe – 工".encode("utf-16-be"), "Höhe – 工", "utf-16be"),
    (PAGE.format("ISO-8859-1").encode("cp1252"), PAGE.format("ISO-8859-1"), "iso-8859-1"),
    (PAGE.format("windows-1252").encode("cp1252"), PAGE.format("windows-1252"), "windows-1252"),
    (PAGE.format("utf-16").encode(), PAGE.format("utf-16"), "utf-8"),
    ("<meta http-equiv=Content-Type content='text/html; charset=Shift_JIS'>給与 +5%".encode("shift_jis"),
     "<meta http-equiv=Content-Type content='text/html; charset=Shift_JIS'>給与 +5%", "shift_jis"),
    ("<META CHARSET=windows-1251>Зарплата".encode("cp1251"), "<META CHARSET=windows-1251>Зарплата", "windows-1251"),
    (PAGE.format("no-such").encode(), PAGE.format("no-such"), "utf-8"),
    (b"a\xffb", "a�b", "utf-8"),
])
def test_charsets(spark, tmp_path, content, text, charset):
    (tmp_path / "a.html").write_bytes(content)
    row = read_html_files(spark, str(tmp_path)).first()
    assert (row.html, row.charset) == (text, charset) and row.path.endswith("a.html")


def test_default_charset_and_null(spark, frame):
    rows = frame([(bytearray("Höhe £5".encode("cp1252")),), (None,)], "content binary")
    found = [r.x for r in rows.select(decoded(F.col("content"), "ISO-8859-1").alias("x")).collect()]
    assert tuple(found[0]) == ("Höhe £5", "iso-8859-1") and found[1] is None

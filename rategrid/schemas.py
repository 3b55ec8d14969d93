"""Explicit schemas of the named tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

SOURCES = _table(
    ("state", _S), ("url", _S), ("type", _S), ("pattern", _S), ("order", _S),
    ("doc_type", _S), ("notes", _S), ("doc_url", _S),
)
SOURCES_AND_FILE = T.StructType([*SOURCES.fields, T.StructField("award_file", _S, True)])
LAYOUTS = _table(
    ("state", _S), ("start_pattern", _S), ("start_offset", _I),
    ("end_pattern", _S), ("end_offset", _I), ("skip_pattern", _S),
)
PAGES = _table(("page_id", _L), ("url", _S), ("html", _S))
PAGE_TEXT = _table(("doc_id", _L), ("page_no", _L), ("text", _S))
LINES = _table(("doc_id", _L), ("line_no", _L), ("line", _S))
CELLS = _table(("doc_id", _L), ("table_no", _I), ("row_no", _L), ("col_no", _I), ("cell", _S))
WORDS = _table(
    ("doc_id", _L), ("page_no", _L), ("x", _I), ("y", _L), ("text", _S), ("space", _B),
)
SALARIES_RAW = _table(("state", _S), ("level", _S), ("annual", _S), ("band", _I))
SALARIES = _table(("state", _S), ("level", _S), ("annual", _D), ("band", _I))
BANDS = _table(("state", _S), ("band", _I), ("lo", _D), ("hi", _D))
REJECTS = _table(("stage", _S), ("key", _S), ("reason", _S))

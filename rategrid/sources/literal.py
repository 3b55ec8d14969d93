"""Small tables written in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Where the pay tables of known awards start and end. Columns as in
# schemas.LAYOUTS; "" means no pattern, None means do not extract.
DEFAULT_LAYOUTS = [
    ("QLD", "", 0, "", 0, ""),
    ("WA", "SALARIES – PROFESSIONAL DIVISION", 2, "SCHEDULE 3", -2, r"^\s+\d+$"),
    ("NSW", "PART B", 2, "PART C", -2, r"(^\s+- \d+ -$)"),
    ("ACT", "ANNEX A – CLASSIFICATIONS AND RATES OF PAY", 1, "ANNEX B", -1,
     r"Page\s+\d{1,3}\s+of\s+\d{1,3}"),
    ("VIC", r"Classification\s+FFPPOA", 0, "Allowances", -2, ""),
    ("SA", None, None, None, None, None),
    ("TAS", None, None, None, None, None),
]
ROADS_LAYOUT = [
    ("MRWA", r"ii\)\s+Specified Calling", 1, r"ii\)\s+Specified Callings cont\.", 0,
     r"^\s*\d{1,3}\s*$"),
]


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows as a table the optimizer knows the size of (a local relation)."""
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)

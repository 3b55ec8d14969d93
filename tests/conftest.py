from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rategrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A small frame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def one(spark):
    """Values of expressions over one row of literals."""
    from pyspark.sql import functions as F

    def evaluate(expression, **columns):
        base = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()], "id")
        return base.select(expression.alias("x")).first()["x"]

    return evaluate

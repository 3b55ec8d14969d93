"""Every query against its SQL on the smallest tables, and the driver's contract."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as driver
from rategrid.plans.catalogue import ORACLES, QUERIES
from tests.check import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and {"state", "band", "lo", "hi"} == set(rows[0].asDict())
    assert max(row["band"] for row in rows) == 5

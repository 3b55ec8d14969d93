"""Compare every query with its SQL: ``python tests/check.py [sf or folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rategrid.plans.catalogue import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    wanted = con.execute(ORACLES[name])
    names = [d[0] for d in wanted.description]
    if sorted(names) != columns:
        return [f"columns {columns} != {sorted(names)}"]
    problems = []
    types = dict(zip(names, [str(d[1]) for d in wanted.description], strict=True))
    for field in found.schema.fields:
        if SAME_TYPE.get(field.dataType.simpleString()) != types[field.name]:
            problems.append(f"{field.name}: {field.dataType.simpleString()} != {types[field.name]}")
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in at) for row in wanted.fetchall()), key=repr)
    actual = sorted((tuple(row) for row in found.select(*columns).collect()), key=repr)
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows, expected {len(expected)}")
    if actual != expected:
        extra = [r for r in actual if r not in set(expected)][:3]
        lacking = [r for r in expected if r not in set(actual)][:3]
        problems.append(f"{columns}\n   extra {extra}\n   lacking {lacking}")
    return problems


def main() -> None:
    from rategrid.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problems = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        for problem in problems:
            print("    ", problem, flush=True)


if __name__ == "__main__":
    main()

"""Tables written between the steps of an operator.

They cut lineage: a step that several later steps read, or that ends an iteration,
is written once to the folder all executors share, and read back. A lost executor
then costs the tasks it ran, not the steps before.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    """The folder of this session; only in local mode is ``spark.checkpoint.dir`` set where it is unset.

    On a cluster a folder of the driver's own would hold nothing of what executors write.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="rategrid-")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{folder(spark)}/rategrid-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, files = _file_system(spark, path)
    files.deleteOnExit(where)
    back = spark.read.schema(df.schema).parquet(path)
    back._stash_path = path
    return back


def steady(df: DataFrame, name: str) -> DataFrame:
    """A table that gives the same rows in the same order whenever a partition is read.

    A plain scan does; rows that have been shuffled may come in another order at a second
    reading, so they are written first.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return stash(df, name) if "Exchange" in plan or "ExistingRDD" in plan else df


def release(df: DataFrame) -> None:
    """Delete a stashed table that nothing reads any more."""
    path = getattr(df, "_stash_path", None)
    if path:
        where, files = _file_system(df.sparkSession, path)
        files.delete(where, True)

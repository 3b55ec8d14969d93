"""Outputs: CSV, and one partition per state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the one the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session. Only in local mode, where driver and executors
    are one process, is a folder made and set where it is unset, as in tests; on a cluster
    executors would each write to their own disk. What is written there goes when the
    application ends.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="rategrid-")
        spark.conf.set(SETTING, root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def write_csv(df: DataFrame, path: str, exact: bool = False) -> None:
    """CSV with a header (RFC 4180): cells with commas, quotes or line ends stand in
    quotes, and quotes in them are doubled.

    Missing values are written as NA. With ``exact`` they are empty cells and empty texts
    stand in quotes, so that ``read_csv(exact=True)`` tells missing values, empty texts and
    the text NA apart.
    """
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', nullValue="" if exact else "NA", emptyValue='""' if exact else "",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_by_state(df: DataFrame, path: str, key: str = "state", whole: bool = False) -> None:
    """Parquet with one folder per state.

    Only the states in ``df`` are written anew; those written before and not in it stay,
    so one state can be extracted again. ``whole`` replaces everything. The files of a
    state change places when the whole job has been written; a job that fails, or loses an
    executor, leaves all of them as they were.

    The rows are rebalanced by state first: small states end up in one file each,
    a large one is split over several tasks and files.
    """
    mode = "static" if whole else "dynamic"
    writer = df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(key).parquet(path)

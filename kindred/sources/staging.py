"""Cut lineage with a table in the cluster's shared checkpoint folder.

A staged frame is computed once, survives the loss of any executor, keeps column
pruning and filter pushdown (it is parquet), and has a known size, so the planner
judges joins with it by fact rather than by guess.  Like a temporary view it lives
as long as the application, unless ``release`` removes it earlier.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Makes Spark remove the shuffle files of a query when the query ends, not when the driver's heap is next collected.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder: tempfile.TemporaryDirectory | None = None


def checkpoint_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset, a temporary folder is made for a session whose driver and
    executors are one process (``local``, ``local[n]``); any other session must set it.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="kindred-")
    return _local_folder.name


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the checkpoint folder, removed when the application ends."""
    path = f"{checkpoint_folder(spark)}/kindred/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind.  Only for writes: nothing else reads the shuffles of their plans."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return a scan of it; the shuffles that made it are removed."""
    spark = df.sparkSession
    path = scratch(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def release(*staged: DataFrame) -> None:
    """Remove staged tables now.  Only for tables that nothing will read again."""
    for df in staged:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

"""Session defaults for running the library stand-alone."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "kindred", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; keyword names use ``__`` for dots.

    ``forceOptimizeSkewedJoin`` lets AQE split a hot key even where a later
    aggregate then needs its own exchange: one extra shuffle is cheaper than one
    task holding a third of the rows.  The pair joins put out many times what they
    read, so small shuffle partitions are worth keeping apart (``minPartitionSize``).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()

"""Evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def absolute_errors(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("error", F.abs(F.col("rating") - F.col("prediction")))


def mae(predictions: DataFrame, model: str, k: int | None = None) -> DataFrame:
    """One metrics row; rows without a prediction do not count, in ``n`` either."""
    return absolute_errors(predictions).agg(
        F.lit(model).alias("model"),
        F.lit(k).cast("int").alias("k"),
        F.count("error").alias("n"),
        F.avg("error").alias("mae"),
    )


def compare(metrics: DataFrame, reference: str) -> DataFrame:
    """Add each model's MAE minus that of ``reference``.

    The window has no key on purpose: a metrics frame has one row per model.
    """
    everything = Window.partitionBy()
    base = F.max(F.when(F.col("model") == reference, F.col("mae"))).over(everything)
    return metrics.withColumn("mae_minus_reference", F.col("mae") - base)

"""Reports over several models, and figures about the similarity table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators import pairs
from kindred.operators.metrics import compare, mae
from kindred.operators.vectors import Fitted
from kindred.plans.baseline import (
    predict_baseline, predict_global, predict_item_mean, predict_user_mean,
)
from kindred.plans.knn import knn_sweep, predict_all_neighbors


def overlap_stats(fitted: Fitted) -> DataFrame:
    """How many items two distinct users share, over all U(U-1)/2 pairs.

    Pairs without a shared item count as overlap 0; they are counted, not formed.
    """
    users = fitted.users.agg(F.count(F.lit(1))).scalar()
    pair_count = F.expr("users * (users - 1) div 2")
    average = F.try_divide(F.col("total"), F.col("pairs"))
    return (
        pairs.pair_stats(fitted, pairs.OVERLAP)
        .withColumn("users", users)
        .withColumn("pairs", pair_count)
        .select(
            "users", "pairs", F.col("shared").alias("overlapping_pairs"),
            F.when(F.col("shared") < F.col("pairs"), 0).otherwise(F.col("low")).cast("bigint").alias("min"),
            F.coalesce("high", F.lit(0)).cast("bigint").alias("max"),
            average.alias("average"),
            F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("squares"), F.col("pairs")) - average * average)).alias("stddev"),
        )
    )


def storage(fitted: Fitted) -> DataFrame:
    """Pairs to compare, and bytes to store all or only non-zero similarities at 8 each."""
    users = fitted.users.agg(F.count(F.lit(1))).scalar()
    return (
        pairs.pair_stats(fitted, pairs.COSINE)
        .withColumn("users", users)
        .withColumn("pairs", F.expr("users * (users - 1) div 2"))
        .select(
            "users", "pairs", (F.col("pairs") * 8).alias("bytes"),
            F.col("nonzero").alias("nonzero_pairs"), (F.col("nonzero") * 8).alias("nonzero_bytes"),
        )
    )


def model_comparison(
    train: DataFrame, test: DataFrame, fitted: Fitted, ks: tuple[int, ...] = (100,)
) -> DataFrame:
    """MAE of every model on the same test rows, and its difference from the baseline's."""
    rows = [
        mae(predict_global(train, test), "global"),
        mae(predict_user_mean(train, test), "user"),
        mae(predict_item_mean(train, test), "item"),
        mae(predict_baseline(train, test, fitted.bounds), "baseline"),
        mae(predict_all_neighbors(fitted, test, pairs.COSINE), "cosine"),
        mae(predict_all_neighbors(fitted, test, pairs.JACCARD), "jaccard"),
        knn_sweep(fitted, test, ks).select(F.lit("knn").alias("model"), "k", "n", "mae"),
    ]
    return compare(reduce(DataFrame.unionByName, rows), "baseline")

"""Predictors from means alone; every plan is lazy and ends in one action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions import denormalise
from kindred.operators.deviations import deviations, item_deviations
from kindred.operators.joins import join_per_key
from kindred.operators.stats import global_mean, item_means, user_means
from kindred.schema import RatingScale


def predict_global(train: DataFrame, test: DataFrame) -> DataFrame:
    return test.withColumn("prediction", global_mean(train))


def predict_user_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    means = user_means(train).select("user_id", F.col("user_mean").alias("prediction"))
    return join_per_key(test, means, "user_id", "item_id")


def predict_item_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    means = item_means(train).select("item_id", F.col("item_mean").alias("prediction"))
    return join_per_key(test, means, "item_id", "user_id")


def predict_baseline(
    train: DataFrame,
    test: DataFrame,
    bounds: RatingScale = RatingScale(),
    cold_items: str = "user_mean",
    deviations_from: DataFrame | None = None,
) -> DataFrame:
    """User mean shifted by the item's mean deviation.

    ``cold_items="user_mean"`` predicts an item unseen in training by the user mean;
    ``"drop"`` leaves such rows out.  Item deviations come from ``train`` unless
    ``deviations_from`` names other rows; user means always come from ``train``.
    """
    if cold_items not in ("user_mean", "drop"):
        raise ValueError(f"unknown cold_items {cold_items!r}")
    means = user_means(train).select("user_id", "user_mean")
    rows = train if deviations_from is None else deviations_from
    item_dev = item_deviations(deviations(rows, means, bounds)).select("item_id", "item_dev")
    how = "left" if cold_items == "user_mean" else "inner"
    with_means = join_per_key(test, means, "user_id", "item_id")
    return join_per_key(with_means, item_dev, "item_id", "user_id", how).withColumn(
        "prediction",
        denormalise(F.col("user_mean"), F.coalesce("item_dev", F.lit(0.0)), bounds),
    )

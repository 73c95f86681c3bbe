"""Normalised deviations from the user mean and their item averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions import deviation
from kindred.operators.joins import join_per_key
from kindred.schema import RatingScale


def deviations(
    ratings: DataFrame, means: DataFrame, bounds: RatingScale = RatingScale()
) -> DataFrame:
    """Ratings of users that have a mean, with their normalised deviation.

    ``means`` may come from another frame than ``ratings``: deviations of held-out
    rows against training means are a valid call.
    """
    joined = join_per_key(ratings, means.select("user_id", "user_mean"), "user_id", "item_id")
    return joined.select(
        "user_id", "item_id", "rating", "user_mean",
        deviation(F.col("rating"), F.col("user_mean"), bounds).alias("dev"),
    )


def item_deviations(devs: DataFrame) -> DataFrame:
    """Mean normalised deviation and number of ratings per item."""
    return devs.groupBy("item_id").agg(
        F.avg("dev").alias("item_dev"), F.count(F.lit(1)).alias("n")
    )


def user_profiles(
    ratings: DataFrame, bounds: RatingScale = RatingScale(), means: DataFrame | None = None
) -> DataFrame:
    """Mean, rating count and L2 norm of the deviations per user.

    The mean is that of ``ratings`` unless ``means`` (user_id, user_mean) says otherwise;
    users without one are left out, and so are rows without a rating.  The ratings are counted by user and
    value first, combined map-side; means are joined, salted, to these counts, so a user with a third of all rows
    costs no task more than another.
    """
    counts = ratings.where(F.col("rating").isNotNull()).groupBy("user_id", "rating").agg(F.count(F.lit(1)).alias("n"))
    if means is None:
        total = F.sum(F.col("rating") * F.col("n"))
        means = counts.groupBy("user_id").agg((total / F.sum("n")).alias("user_mean"))
    joined = join_per_key(counts, means.select("user_id", "user_mean"), "user_id", "rating")
    dev = deviation(F.col("rating"), F.col("user_mean"), bounds)
    return joined.groupBy("user_id").agg(
        F.max("user_mean").alias("user_mean"),
        F.sum("n").alias("n_rated"),
        F.sqrt(F.sum(F.col("n") * dev * dev)).alias("norm"),
    )


def processed_deviations(
    ratings: DataFrame, profiles: DataFrame, bounds: RatingScale = RatingScale()
) -> DataFrame:
    """Deviations with their L2-normalised form; NULL for a user of norm zero."""
    joined = join_per_key(ratings, profiles, "user_id", "item_id")
    return joined.withColumn(
        "dev", deviation(F.col("rating"), F.col("user_mean"), bounds)
    ).withColumn("pdev", F.try_divide(F.col("dev"), F.col("norm"))).drop("norm")

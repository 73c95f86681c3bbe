"""Means and descriptive statistics of a ratings frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.joins import join_per_key


def global_mean(ratings: DataFrame) -> Column:
    """Mean rating as a scalar subquery: computed once, inlined as a literal."""
    return ratings.agg(F.avg("rating")).scalar()


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(
        F.avg("rating").alias("user_mean"), F.count("rating").alias("n")
    )


def item_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(
        F.avg("rating").alias("item_mean"), F.count("rating").alias("n")
    )


def mean_spread(means: DataFrame, column: str, centre: Column, within: float = 0.5) -> DataFrame:
    """How group means spread around ``centre``: one row.

    ``midrange`` is halfway between the extremes, ``average`` the mean of the
    group means.  A group is close when it is strictly within ``within``.
    """
    mean = F.col(column)
    flagged = means.select(
        mean.alias("m"), ((mean < centre + within) & (mean > centre - within)).alias("close")
    )
    return flagged.agg(
        F.count(F.lit(1)).alias("groups"),
        F.min("m").alias("min"),
        F.max("m").alias("max"),
        ((F.min("m") + F.max("m")) / 2).alias("midrange"),
        F.avg("m").alias("average"),
        F.avg(F.col("close").cast("double")).alias("ratio_close"),
        F.every("close").alias("all_close"),
    )


def rating_stats(ratings: DataFrame, within: float = 0.5) -> DataFrame:
    """Global mean plus the spread of user means and of item means, one row each."""
    centre = global_mean(ratings)
    users = mean_spread(user_means(ratings), "user_mean", centre, within)
    items = mean_spread(item_means(ratings), "item_mean", centre, within)
    return users.select(F.lit("user").alias("grouped_by"), centre.alias("global_mean"), "*").unionByName(
        items.select(F.lit("item").alias("grouped_by"), centre.alias("global_mean"), "*")
    )


def item_sets(ratings: DataFrame) -> DataFrame:
    """Each user's set of items in long form, with its size.

    One row per member: an array per user would put a user's whole history into one
    row, however long it is.
    """
    members = ratings.select("user_id", "item_id").distinct()
    sizes = members.groupBy("user_id").agg(F.count(F.lit(1)).alias("set_size"))
    return join_per_key(members, sizes, "user_id", "item_id")

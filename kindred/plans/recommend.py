"""Top-n recommendations, or all items ranked (n=None).  Ties go to the smaller item id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import denormalise, rounded
from kindred.operators.deviations import deviations, item_deviations
from kindred.operators.neighbors import from_top_k, top_k_of
from kindred.operators.order import rank_in_ranges
from kindred.operators.stats import user_means
from kindred.operators.vectors import Fitted
from kindred.operators.weighting import full_table_sums, weighted_prediction, with_user_means
from kindred.schema import RatingScale
from kindred.sources.staging import stage

# Predictions are compared after rounding, so that the last bits of a sum do not
# decide between items the rule says are tied.
PREDICTION_PLACES = 9


def _top_of_one(scored: DataFrame, n: int | None) -> DataFrame:
    """The n best rows overall: TakeOrderedAndProject, then a rank over those n rows; all rows without n."""
    if n is None:
        return rank_in_ranges(scored, [F.desc("prediction"), F.asc("item_id")])
    best = scored.orderBy(F.desc("prediction"), F.asc("item_id")).limit(n)
    return best.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc("prediction"), F.asc("item_id")))
    )


def top_n(scored: DataFrame, n: int | None) -> DataFrame:
    """The n best items of each user, ranked; all of them without n."""
    if n is None:
        return rank_in_ranges(scored, [F.desc("prediction"), F.asc("item_id")], ("user_id",))
    best_first = Window.partitionBy("user_id").orderBy(F.desc("prediction"), F.asc("item_id"))
    return scored.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)


def with_titles(recommendations: DataFrame, items: DataFrame | None) -> DataFrame:
    """Attach titles; an item without one keeps NULL."""
    if items is None:
        return recommendations
    return recommendations.join(items.select("item_id", "title"), "item_id", "left")


def unrated(candidates: DataFrame, rated: DataFrame) -> DataFrame:
    """Drop the (user, item) cells the user has rated."""
    return candidates.join(rated.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def baseline_scores(
    ratings: DataFrame, personal: DataFrame, user_id: int,
    weight: Column | None = None, bounds: RatingScale = RatingScale(), exclude_rated: bool = True,
) -> DataFrame:
    """Baseline prediction of every item for one user known by its personal ratings.

    The personal ratings give the user's mean; they do not enter the item deviations.
    """
    mine = personal.where(F.col("user_id") == user_id)
    mean = mine.agg(F.avg("rating")).scalar()
    devs = item_deviations(deviations(ratings, user_means(ratings), bounds))
    value = denormalise(F.col("mean"), F.col("item_dev"), bounds)
    scored = devs.withColumn("mean", mean).select(
        F.lit(user_id).cast("bigint").alias("user_id"), "item_id",
        rounded(value if weight is None else weight * value, PREDICTION_PLACES).alias("prediction"),
    )
    return unrated(scored, mine) if exclude_rated else scored


def recommend_baseline(
    ratings: DataFrame, personal: DataFrame, user_id: int, n: int | None = 5,
    items: DataFrame | None = None, bounds: RatingScale = RatingScale(), exclude_rated: bool = True,
) -> DataFrame:
    scored = baseline_scores(ratings, personal, user_id, None, bounds, exclude_rated)
    return with_titles(_top_of_one(scored, n), items)


def recommend_popular(
    ratings: DataFrame, personal: DataFrame, user_id: int, n: int | None = 5,
    items: DataFrame | None = None, bounds: RatingScale = RatingScale(), exclude_rated: bool = True,
) -> DataFrame:
    """Baseline predictions weighted by the item's share of the largest rating count."""
    most = (
        ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    )
    scored = baseline_scores(
        ratings, personal, user_id, F.col("n") / most, bounds, exclude_rated
    )
    return with_titles(_top_of_one(scored, n), items)


def _knn_scores(neighbors: DataFrame, fitted: Fitted) -> DataFrame:
    scored = with_user_means(full_table_sums(neighbors, fitted), fitted).select(
        "user_id", "item_id",
        rounded(
            weighted_prediction(
                F.col("num"), F.col("den"), F.col("user_mean"), fitted.bounds, "drop"
            ),
            PREDICTION_PLACES,
        ).alias("prediction"),
    )
    return unrated(scored.where(F.col("prediction").isNotNull()), fitted.vectors)


def recommend_knn(
    fitted: Fitted, targets: DataFrame, k: int, n: int | None = 5, items: DataFrame | None = None
) -> DataFrame:
    """Top n unrated items for each user in ``targets`` (user_id), from its k nearest users.

    ``fitted`` must include the targets' own ratings.
    """
    scored = _knn_scores(top_k_of(fitted, targets, k), fitted)
    return with_titles(top_n(scored, n), items)


def recommend_knn_for_ks(
    fitted: Fitted, targets: DataFrame, ks: tuple[int, ...], n: int | None = 5, items: DataFrame | None = None
) -> DataFrame:
    """The same for several k, with a column k: neighbours are searched once, at the largest.

    ``targets`` is staged: a list of constants would turn the join that selects the targets'
    rows into one without a key.
    """
    nearest = stage(top_k_of(fitted, stage(targets.select("user_id"), "targets"), max(ks)), "nearest")
    tops = [
        top_n(_knn_scores(nearest.where(F.col("rank") <= k), fitted), n).withColumn("k", F.lit(k)) for k in ks
    ]
    return with_titles(reduce(DataFrame.unionByName, tops), items)


def recommend_knn_all(
    fitted: Fitted, k: int, n: int | None = 5, items: DataFrame | None = None
) -> DataFrame:
    """The same for every user of the fitted ratings."""
    return with_titles(from_top_k(fitted, k, lambda neighbors: top_n(_knn_scores(neighbors, fitted), n)), items)

"""Similarities of user pairs.

Without hot items and with many pairs, all of them come from lists of co-raters (operators.lists).  Otherwise
every unordered pair of users is handled in exactly one of two ways:

* joined: at least one of the two is not tiled.  They share no hot item (or one of
  them is among the few users with a very long list), so an equi-join on the item
  produces at most ``hot_item_ratings`` partners per rating.
* tiled: both rated some hot item.  Their block of the user x user table is filled
  in one task, and only what the caller needs of it leaves the task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import rounded
from kindred.operators import lists, tiles
from kindred.operators.vectors import Fitted
from kindred.schema import SIMILARITY_PLACES

COSINE, JACCARD, OVERLAP = "cosine", "jaccard", "overlap"


def usable(vectors: DataFrame, metric: str) -> DataFrame:
    """Rows that can take part: a user of norm zero has no cosine with anyone."""
    if metric not in (COSINE, JACCARD, OVERLAP):
        raise ValueError(f"unknown metric {metric!r}")
    rows = vectors.where(F.col("pdev").isNotNull()) if metric == COSINE else vectors
    return rows.withColumn("weight", F.col("pdev") if metric == COSINE else F.lit(1.0))


def similarity_of(metric: str, size: Column) -> Column:
    """Aggregate over the shared items of one pair; ``size`` is n(u) + n(v)."""
    if metric == COSINE:
        return rounded(F.sum("product"), SIMILARITY_PLACES)
    shared = F.count(F.lit(1))
    if metric == OVERLAP:
        return shared.cast("double")
    union = F.max(size) - shared
    return rounded(F.coalesce(F.try_divide(shared, union), F.lit(0.0)), SIMILARITY_PLACES)


def _products(fitted: Fitted, metric: str) -> DataFrame:
    """Joined pairs (a, b) once per shared item, in both directions if both are untiled.

    The right side holds untiled users only, so a hot item brings all its raters on
    the left but next to none on the right.
    """
    rows = usable(fitted.vectors, metric)
    left = rows.select(
        "item_id", F.col("user_id").alias("a"), F.col("tiled").alias("a_tiled"),
        F.col("weight").alias("a_weight"), F.col("n_rated").alias("a_n"),
    )
    right = rows if fitted.hot_items is None else rows.where(~F.col("tiled"))
    right = right.select(
        "item_id", F.col("user_id").alias("b"),
        F.col("weight").alias("b_weight"), F.col("n_rated").alias("b_n"),
    )
    return (
        left.join(right, "item_id")
        .withColumn("product", F.col("a_weight") * F.col("b_weight"))
        .withColumn("size", F.col("a_n") + F.col("b_n"))
    )


def _similarities(products: DataFrame, metric: str) -> DataFrame:
    return products.groupBy("user_id", "neighbor_id").agg(
        similarity_of(metric, F.col("size")).alias("similarity")
    )


def joined_pairs(fitted: Fitted, metric: str) -> DataFrame:
    """Pairs of which at least one user is not tiled, as user_id < neighbor_id.

    Taking one direction per pair halves the join output and the aggregate.
    """
    once = F.col("a") < F.col("b")
    if fitted.hot_items is not None:
        once = F.col("a_tiled") | once
    products = _products(fitted, metric).where(once)
    return _similarities(
        products.select(
            F.least("a", "b").alias("user_id"), F.greatest("a", "b").alias("neighbor_id"),
            "product", "size",
        ),
        metric,
    )


def joined_edges(fitted: Fitted, metric: str) -> DataFrame:
    """The same pairs in both directions, ready to be ranked per user.

    As long as every list is short, both directions are joined and shuffled once, by
    user, and need no other shuffle to be summed and ranked.  With long lists, one
    user's products are too many for one task: then single pairs are summed, spread
    by pair, and mirrored.
    """
    if fitted.long_groups:
        return mirror(joined_pairs(fitted, metric))
    products = _products(fitted, metric).where(F.col("a") != F.col("b")).select(
        F.col("a").alias("user_id"), F.col("b").alias("neighbor_id"), "product", "size"
    )
    return _similarities(products.repartition("user_id"), metric)


def similarity_pairs(fitted: Fitted, metric: str = COSINE) -> DataFrame:
    """All co-rating pairs, user_id < neighbor_id.  The result itself is one row per
    pair; operators that need less of it have their own entry points below."""
    if parts := lists.part_count(fitted):
        return lists.list_pairs(usable(fitted.vectors, metric), fitted, metric, parts)
    joined = joined_pairs(fitted, metric)
    if fitted.hot_items is None:
        return joined
    return joined.unionByName(
        tiles.tile_pairs(usable(fitted.vectors, metric), fitted.settings, metric)
    )


def mirror(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair."""
    ends = F.explode(F.array(
        F.struct(F.col("user_id").alias("u"), F.col("neighbor_id").alias("v")),
        F.struct(F.col("neighbor_id").alias("u"), F.col("user_id").alias("v")),
    ))
    return pairs.select(ends.alias("e"), "similarity").select(
        F.col("e.u").alias("user_id"), F.col("e.v").alias("neighbor_id"), "similarity"
    )


def pair_stats(fitted: Fitted, metric: str) -> DataFrame:
    """One row about all pairs: how many share an item, how many have a non-zero
    similarity, and sum, sum of squares, minimum and maximum of the similarity.
    Tiles and parts contribute one partial row each, never their pairs."""
    if parts := lists.part_count(fitted):
        return _total_stats(lists.list_stats(usable(fitted.vectors, metric), fitted, metric, parts))
    stats = joined_pairs(fitted, metric).agg(
        F.count(F.lit(1)).alias("shared"),
        F.count_if(F.col("similarity") != 0).alias("nonzero"),
        F.sum("similarity").alias("total"),
        F.sum(F.col("similarity") * F.col("similarity")).alias("squares"),
        F.min("similarity").alias("low"),
        F.max("similarity").alias("high"),
    )
    if fitted.hot_items is None:
        return stats
    tiled = tiles.tile_stats(usable(fitted.vectors, metric), fitted.settings, metric)
    return _total_stats(stats.unionByName(tiled))


def _total_stats(partial: DataFrame) -> DataFrame:
    return partial.agg(
        F.sum("shared").alias("shared"), F.sum("nonzero").alias("nonzero"),
        F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )

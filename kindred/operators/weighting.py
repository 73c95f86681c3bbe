"""Similarity-weighted deviation sums and the predictions made from them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import denormalise
from kindred.operators import lists, pairs, tiles
from kindred.operators.joins import join_per_key
from kindred.operators.neighbors import top_k
from kindred.operators.vectors import Fitted
from kindred.schema import RatingScale
from kindred.sources.staging import stage


def raters(fitted: Fitted, hot: bool | None = None) -> DataFrame:
    """item_id, neighbor_id, dev of all ratings, or of hot / other items only."""
    rows = fitted.vectors
    if hot is False and fitted.light is not None:
        rows = fitted.light
    elif hot is not None and fitted.hot_items is not None:
        rows = rows.where(F.col("hot") if hot else ~F.col("hot"))
    return rows.select("item_id", F.col("user_id").alias("neighbor_id"), "dev")


def neighbor_terms(wanted: DataFrame, edges: DataFrame, fitted: Fitted) -> DataFrame:
    """One row per wanted row (u, i) and neighbour v of u that rated i.

    For an item with few raters the raters are looked up first and then matched
    with the edges; for a hot item the edges come first and the raters are matched
    on (neighbour, item).  A cell therefore never meets more than
    min(raters, hot_item_ratings) or (number of edges of its user) candidates.
    Columns of ``edges`` beyond user_id and neighbor_id are carried along.
    """
    cells = wanted.select("user_id", "item_id")
    by_item = cells.join(raters(fitted, hot=False), "item_id").join(edges, ["user_id", "neighbor_id"])
    if fitted.hot_items is None:
        return by_item
    return by_item.unionByName(_hot_item_terms(cells, edges, fitted))


def _hot_item_terms(cells: DataFrame, edges: DataFrame, fitted: Fitted) -> DataFrame:
    return (
        cells.join(fitted.hot_items, "item_id", "left_semi")
        .join(edges, "user_id")
        .join(raters(fitted, hot=True), ["neighbor_id", "item_id"])
    )


def co_rater_terms(wanted: DataFrame, fitted: Fitted, metric: str) -> DataFrame:
    """The same over all joined pairs, without forming their second direction: a cell
    and a rater look their pair up by its smaller and larger user."""
    cells = wanted.select("user_id", "item_id")
    joined = pairs.joined_pairs(fitted, metric)
    if fitted.hot_items is not None:  # read twice below, once mirrored
        joined = stage(joined, "pairs")
    ordered = joined.select(
        F.col("user_id").alias("low"), F.col("neighbor_id").alias("high"), "similarity"
    )
    met = (
        cells.join(raters(fitted, hot=False), "item_id")
        .withColumn("low", F.least("user_id", "neighbor_id"))
        .withColumn("high", F.greatest("user_id", "neighbor_id"))
    )
    if fitted.long_groups:
        terms = join_per_key(met, ordered, ["low", "high"], "item_id")
    else:
        terms = met.join(ordered, ["low", "high"])
    terms = terms.drop("low", "high")
    if fitted.hot_items is None:
        return terms
    return terms.unionByName(_hot_item_terms(cells, pairs.mirror(joined), fitted))


def _sums(when: Column | None = None) -> tuple[Column, Column]:
    s, dev = F.col("similarity"), F.col("dev")
    if when is not None:
        s = F.when(when, s)
    return F.sum(s * dev), F.sum(F.abs(s))


def nearest_sums(wanted: DataFrame, fitted: Fitted, k: int, metric: str) -> DataFrame:
    """Weighted sums of wanted cells over the k nearest of all users."""
    if parts := lists.part_count(fitted):
        return _named(lists.list_sums(pairs.usable(fitted.vectors, metric), fitted, metric, wanted, [k], parts), k)
    return knn_sums(wanted, top_k(fitted, k, metric), fitted)


def nearest_sums_for_ks(wanted: DataFrame, fitted: Fitted, ks: list[int], metric: str) -> DataFrame:
    """The same for several k, ranked once."""
    if parts := lists.part_count(fitted):
        return lists.list_sums(pairs.usable(fitted.vectors, metric), fitted, metric, wanted, ks, parts)
    return knn_sums_for_ks(wanted, top_k(fitted, ks[-1], metric), fitted, ks)


def _named(sums: DataFrame, k: int | None) -> DataFrame:
    return sums.withColumnsRenamed({f"num_{k}": "num", f"den_{k}": "den"})


def knn_sums(wanted: DataFrame, neighbors: DataFrame, fitted: Fitted) -> DataFrame:
    """Weighted sums of wanted cells over the given neighbours.

    A cell asked for twice has both sums doubled, which leaves their quotient alone;
    so the wanted rows need no shuffle to make them distinct.
    """
    num, den = _sums()
    terms = neighbor_terms(wanted, neighbors.select("user_id", "neighbor_id", "similarity"), fitted)
    return terms.groupBy("user_id", "item_id").agg(num.alias("num"), den.alias("den"))


def knn_sums_for_ks(
    wanted: DataFrame, neighbors: DataFrame, fitted: Fitted, ks: list[int]
) -> DataFrame:
    """Weighted sums for several k from one ranking at the largest k.

    Conditional sums, one pair per k, instead of one copy of the terms per k.
    """
    edges = neighbors.select("user_id", "neighbor_id", "similarity", "rank")
    sums = []
    for k in ks:
        num, den = _sums(F.col("rank") <= k)
        sums += [num.alias(f"num_{k}"), den.alias(f"den_{k}")]
    return neighbor_terms(wanted, edges, fitted).groupBy("user_id", "item_id").agg(*sums)


def all_neighbor_sums(wanted: DataFrame, fitted: Fitted, metric: str) -> DataFrame:
    """Weighted sums of wanted cells over every co-rater.

    Pairs of tiled users are weighted inside their tile and leave it as partial
    sums; the others go through the pair join.
    """
    cells = wanted.select("user_id", "item_id")
    if parts := lists.part_count(fitted):
        return _named(lists.list_sums(pairs.usable(fitted.vectors, metric), fitted, metric, cells, [None], parts), None)
    num, den = _sums()
    joined = (
        co_rater_terms(cells, fitted, metric)
        .groupBy("user_id", "item_id")
        .agg(num.alias("num"), den.alias("den"))
    )
    if fitted.hot_items is None:
        return joined
    rows = pairs.usable(fitted.vectors, metric)
    wanted = join_per_key(cells, fitted.users.select("user_id", "tiled"), "user_id", "item_id").where("tiled")
    wanted = wanted.join(fitted.hot_items.withColumn("hot", F.lit(True)), "item_id", "left")
    wanted = wanted.withColumn("hot", F.coalesce("hot", F.lit(False)))
    light = rows.where("tiled and not hot").select("item_id", F.col("user_id").alias("b"), F.col("dev").alias("value"))
    terms = wanted.where("not hot").select("item_id", F.col("user_id").alias("a")).join(light, "item_id").where("a <> b")
    tiled = tiles.tile_sums(rows, fitted.settings, metric, wanted, terms)
    return (
        joined.unionByName(tiled)
        .groupBy("user_id", "item_id")
        .agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
    )


def full_table_sums(neighbors: DataFrame, fitted: Fitted) -> DataFrame:
    """Weighted sums of every cell (u, i) that at least one neighbour of u rated."""
    edges = neighbors.select("user_id", "neighbor_id", "similarity")
    num, den = _sums()
    rows = raters(fitted if fitted.by_user is None else replace(fitted, vectors=fitted.by_user))
    return (
        edges.join(rows, "neighbor_id")
        .groupBy("user_id", "item_id")
        .agg(num.alias("num"), den.alias("den"))
    )


def weighted_prediction(
    num: Column, den: Column, mean: Column, bounds: RatingScale, fallback: str
) -> Column:
    """Rating predicted from weighted sums.

    Without a usable neighbour (no term, or all weights zero) the result is the
    user mean (``fallback="user_mean"``) or NULL (``fallback="drop"``).
    """
    if fallback not in ("user_mean", "drop"):
        raise ValueError(f"unknown fallback {fallback!r}")
    value = denormalise(mean, F.try_divide(num, den), bounds)
    return F.coalesce(value, mean) if fallback == "user_mean" else value


def predict(
    pairs_wanted: DataFrame, sums: DataFrame, fitted: Fitted, fallback: str = "user_mean"
) -> DataFrame:
    """Predictions for rows (user_id, item_id, ...) whose user has a mean."""
    return (
        with_user_means(pairs_wanted, fitted)
        .join(sums, ["user_id", "item_id"], "left")
        .withColumn(
            "prediction",
            weighted_prediction(
                F.col("num"), F.col("den"), F.col("user_mean"), fitted.bounds, fallback
            ),
        )
        .drop("num", "den")
    )


def with_user_means(cells: DataFrame, fitted: Fitted) -> DataFrame:
    """Rows (user_id, item_id, ...) of fitted users with the user's mean."""
    return join_per_key(cells, fitted.users.select("user_id", "user_mean"), "user_id", "item_id")

"""Top-k neighbours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import rounded
from kindred.operators import bounded, lists, pairs, tiles
from kindred.operators.order import rank_in_ranges
from kindred.operators.vectors import Fitted
from kindred.schema import SIMILARITY_PLACES


def rank_edges(edges: DataFrame, k: int | None = None) -> DataFrame:
    """Rank each user's neighbours by similarity, ties by smaller neighbour id.

    With ``k`` the limit is applied inside every partition before the shuffle
    (WindowGroupLimit), so at most k rows per user and partition travel.  Edges that
    are partitioned by user already are not shuffled again.
    """
    best_first = Window.partitionBy("user_id").orderBy(F.desc("similarity"), F.asc("neighbor_id"))
    ranked = edges.withColumn("rank", F.row_number().over(best_first))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def rank_long_lists(edges: DataFrame) -> DataFrame:
    """Rank all neighbours where one user may have too many to sort in one task.

    Ranges are cut where the edges are, so many neighbours of one similarity are divided, too.
    """
    ranked = rank_in_ranges(edges, [F.desc("similarity"), F.asc("neighbor_id")], ("user_id",))
    return ranked.select("user_id", "neighbor_id", "similarity", "rank")


def top_k(fitted: Fitted, k: int | None, metric: str = pairs.COSINE) -> DataFrame:
    """user_id, neighbor_id, similarity, rank for the k most similar co-raters.

    ``k=None`` ranks all of them.
    """
    return from_top_k(fitted, k, lambda neighbors: neighbors, metric)


def from_top_k(
    fitted: Fitted, k: int | None, then: Callable[[DataFrame], DataFrame], metric: str = pairs.COSINE
) -> DataFrame:
    """The rows that ``then`` makes of the k most similar co-raters.

    Where users are served in rounds (operators.lists), it is called with the neighbours of each round's users, all of a
    user's at once, so that the neighbours, and what joins with them, are never on disk for all users together.
    """
    if parts := lists.part_count(fitted):
        return lists.list_ranks(pairs.usable(fitted.vectors, metric), fitted, metric, k, parts, then)
    return then(_top_k(fitted, k, metric))


def _top_k(fitted: Fitted, k: int | None, metric: str) -> DataFrame:
    """The same by the item join and tiles."""
    if k is None and fitted.long_groups:
        return rank_long_lists(pairs.mirror(pairs.similarity_pairs(fitted, metric)))
    edges = pairs.joined_edges(fitted, metric)
    if fitted.hot_items is not None:
        rows = pairs.usable(fitted.vectors, metric)
        if metric == pairs.COSINE and fitted.settings.skip_tiles is not False:
            edges = bounded.top_k_tiled(rows, edges, fitted.settings, metric, k)
        else:
            edges = edges.unionByName(tiles.tile_top_k(rows, fitted.settings, metric, k))
    return rank_edges(edges, k)


def top_k_of(fitted: Fitted, targets: DataFrame, k: int) -> DataFrame:
    """Cosine neighbours of the users in ``targets`` only.

    The target's rows are selected before the join, so the work per target is at
    most one pass over the ratings of the items it rated.
    """
    rows = pairs.usable(fitted.vectors, pairs.COSINE)
    mine = rows.join(targets.select("user_id"), "user_id", "left_semi").select(
        "item_id", "user_id", F.col("weight").alias("my_weight")
    )
    others = rows.select("item_id", F.col("user_id").alias("neighbor_id"), "weight")
    edges = (
        mine.join(others, "item_id")
        .where(F.col("user_id") != F.col("neighbor_id"))
        .groupBy("user_id", "neighbor_id")
        .agg(
            rounded(F.sum(F.col("my_weight") * F.col("weight")), SIMILARITY_PLACES).alias("similarity")
        )
    )
    return rank_edges(edges, k)


def neighbor_lists(neighbors: DataFrame) -> DataFrame:
    """One row per user with its neighbours as an array in rank order (an output form)."""
    entry = F.struct("rank", "neighbor_id", "similarity")
    return neighbors.groupBy("user_id").agg(F.sort_array(F.collect_list(entry)).alias("neighbors"))

"""The k nearest of users of hot items, without the tiles that cannot hold any of them.

A cosine is a sum over shared items: what a pair shares of light items is known from the item join, what it
shares of hot items is at most the product of the users' norms over them, range of items by range (Cauchy-Schwarz).
So a pair has a lower and an upper bound before any tile is opened.

1. Users are placed in blocks by their norm over hot items, so that blocks of small norms have small bounds.
2. Each user's k-th best so far, its *floor*, comes from its own block's tile, from pairs with untiled users and from the lower
   bounds of light pairs with other blocks.  These are different partners, so the true k-th best is no lower.
3. A user goes to the tile with another block only if some pair there can reach the floor of either user: by the largest norms
   of the block and its lowest floor, or by a light pair between the two.  Whoever could be the partner goes there by
   the same test.  Tiles that lack a side are not opened.

The result is that of all tiles; only work is saved.  How much depends on how the ratings are divided between hot and light
items: where the typical user's norm over hot items is large, bounds reach every floor and all tiles are opened at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators import tiles
from kindred.operators.joins import join_per_key
from kindred.schema import FitSettings
from kindred.sources.staging import stage

# Ranges of hot items over which partial norms are formed, and of norms by which users are placed.
ITEM_RANGES = 8
NORM_RANGES = 16
# Bounds are worth forming if the product of two typical norms over hot items is at most this.
PROMISING = 0.2
# No floor: fewer than k partners are known.
NOTHING = -2.0
# Similarities are rounded to nine places before they are compared.
SLACK = 1e-8


def placed_users(rows: DataFrame, settings: FitSettings) -> DataFrame:
    """user_id, block, norm and norms (by range of items) of the tiled users, over hot items."""
    at = F.pmod(F.xxhash64("item_id"), F.lit(ITEM_RANGES))
    square = F.col("weight") * F.col("weight")
    norms = rows.where("tiled and hot").groupBy("user_id").agg(
        F.sqrt(F.sum(square)).alias("norm"), F.count(F.lit(1)).alias("n_hot"),
        F.array(*[F.sqrt(F.coalesce(F.sum(F.when(at == g, square)), F.lit(0.0))) for g in range(ITEM_RANGES)]).alias("norms"),
    )
    norms = stage(norms, "norms")
    cuts = norms.agg(F.percentile_approx("norm", [i / NORM_RANGES for i in range(1, NORM_RANGES)])).scalar()
    ranged = norms.withColumn("cuts", cuts).withColumn("range", F.size(F.filter("cuts", lambda c: c < F.col("norm")))).drop("cuts")
    # One row per range of norms: NORM_RANGES rows at most.
    sizes = ranged.groupBy("range").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / settings.tile_users, F.sum("n_hot") / settings.tile_ratings)).cast("int").alias("parts")
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("offset", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int"))
    part = F.pmod(F.xxhash64("user_id"), F.col("parts")).cast("int")
    return ranged.join(F.broadcast(sizes), "range").select("user_id", (F.col("offset") + part).alias("block"), "norm", "norms")


def best_per_user(edges: DataFrame, k: int) -> DataFrame:
    """The k best edges of each user; the limit is applied before the shuffle, too."""
    order = Window.partitionBy("user_id").orderBy(F.desc("similarity"), "neighbor_id")
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _light(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Light sums of pairs of tiled users with the block and norm of both."""
    found = tiles.light_sums(rows).withColumn("kind", F.lit(tiles.SUM)).withColumn("item_id", F.lit(0).cast("bigint"))
    for user, other in (("a", "b"), ("b", "a")):
        side = places.select(F.col("user_id").alias(user), F.col("block").alias(f"{user}_block"), F.col("norm").alias(f"{user}_norm"))
        found = join_per_key(found, side, user, other)
    return found


def _both_ends(pairs: DataFrame, *values: str) -> DataFrame:
    """(user_id, other, other_block, values) for both users of each pair."""
    ends = [F.struct(F.col(x).alias("user_id"), F.col(y).alias("other"), F.col(f"{y}_block").alias("other_block")) for x, y in (("a", "b"), ("b", "a"))]
    return pairs.select(F.explode(F.array(*ends)).alias("e"), *values).select("e.*", *values)


def floors(first: DataFrame, light: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """``places`` with the k-th best similarity that each user is sure to reach.

    ``first``: similarities of pairs with the own block and with untiled users; ``light``: pairs with other blocks.
    """
    least = F.col("value") - F.col("a_norm") * F.col("b_norm")
    sure = _both_ends(light.withColumn("least", least), "least").select("user_id", F.col("least").alias("similarity"))
    known = first.select("user_id", "similarity").unionByName(sure)
    kth = best_per_user(known.withColumn("neighbor_id", F.lit(0)), k)
    kth = kth.groupBy("user_id").agg(F.when(F.count(F.lit(1)) == k, F.min("similarity")).alias("kth"))
    return places.join(kth, "user_id", "left").select(
        "user_id", "block", "norm", "norms", F.coalesce(F.col("kth") - SLACK, F.lit(NOTHING)).alias("floor")
    )


def visits(places: DataFrame, light: DataFrame) -> DataFrame:
    """(user_id, block, other): the other blocks that each user must be compared with."""
    blocks = places.groupBy("block").agg(
        F.min("floor").alias("floor"), F.max("norm").alias("norm"),
        F.array(*[F.max(F.col("norms")[g]) for g in range(ITEM_RANGES)]).alias("norms"),
    )
    # One entry per block: users / tile_users of them.
    profiles = blocks.agg(F.collect_list(F.struct("block", "floor", "norm", "norms"))).scalar()
    by_range: Column = sum((F.col("norms")[g] * F.col("p.norms")[g] for g in range(ITEM_RANGES)), F.lit(0.0))
    reach = F.least(by_range, F.col("norm") * F.col("p.norm"))
    # Also without shared hot items a pair has 0 at most.
    seen = places.withColumn("p", F.explode(profiles)).where(
        (F.col("p.block") != F.col("block")) & (reach >= F.least("floor", "p.floor"))
    ).select("user_id", "block", F.col("p.block").alias("other"))
    most = light.withColumn("most", F.col("value") + F.col("a_norm") * F.col("b_norm"))
    for user, other in (("a", "b"), ("b", "a")):
        side = places.select(F.col("user_id").alias(user), F.col("floor").alias(f"{user}_floor"))
        most = join_per_key(most, side, user, other)
    reaching = _both_ends(most.where(F.col("most") >= F.least("a_floor", "b_floor")))
    reaching = reaching.groupBy("user_id", F.col("other_block").alias("other")).agg(F.lit(0).alias("seen"))
    reaching = join_per_key(reaching.drop("seen"), places.select("user_id", "block"), "user_id", "other")
    return seen.unionByName(reaching.select("user_id", "block", "other")).distinct()


def opened(visits: DataFrame) -> DataFrame:
    """(tile_i, tile_j) of the tiles between two blocks that users of both go to."""
    sides = visits.groupBy(F.least("block", "other").alias("tile_i"), F.greatest("block", "other").alias("tile_j")).agg(
        F.min("block").alias("low"), F.max("block").alias("high")
    )
    return sides.where("low < high").select("tile_i", "tile_j")


def promising(places: DataFrame) -> bool:
    typical = places.agg(F.percentile_approx("norm", 0.5)).first()[0]
    return typical is not None and typical * typical <= PROMISING


def top_k_tiled(rows: DataFrame, untiled: DataFrame, settings: FitSettings, metric: str, k: int) -> DataFrame:
    """Edges among which are the k best of every user: user_id, neighbor_id, similarity.

    ``untiled``: the edges of pairs with an untiled user, both directions.
    """
    places = stage(placed_users(rows, settings), "places")
    if settings.skip_tiles is None and not promising(places):
        return untiled.unionByName(tiles.tile_top_k(rows, settings, metric, k))
    light = stage(_light(rows, places), "light-pairs")
    heavy = rows.where("tiled and hot").select("user_id", "item_id", "weight", "dev", "n_rated", F.lit(False).alias("wanted"))
    heavy = join_per_key(heavy, places.select("user_id", "block"), "user_id", "item_id")
    emit = tiles.top_k_of_tile(metric, k)

    inside = light.where("a_block = b_block")
    first = tiles.per_tile(tiles.to_tiles(heavy, F.array("block")), tiles.light_tiles(inside), emit, tiles.PAIR_SCHEMA)
    first = best_per_user(first.unionByName(untiled.select("user_id", "neighbor_id", "similarity")), k)
    first = stage(first, "first")

    between = light.where("a_block <> b_block")
    users = stage(floors(first, between, places, k), "floors")
    needed = stage(visits(users, between), "visits")
    pairs = stage(opened(needed), "opened")
    keys = ["tile_i", "tile_j"]
    going = needed.select("user_id", "other", F.least("block", "other").alias("tile_i"), F.greatest("block", "other").alias("tile_j"))
    going = going.join(pairs, keys, "left_semi").groupBy("user_id").agg(F.collect_list("other").alias("others"))
    sent = tiles.to_tiles(join_per_key(heavy, going, "user_id", "item_id"), F.col("others"))
    sums = tiles.light_tiles(between).join(pairs, keys, "left_semi")
    return first.unionByName(tiles.per_tile(sent, sums, emit, tiles.PAIR_SCHEMA))

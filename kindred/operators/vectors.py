"""The fitted state every similarity operator works from."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.deviations import processed_deviations, user_profiles
from kindred.schema import FitSettings, RatingScale
from kindred.sources.staging import stage

# A list of ids up to this long (16 MB of keys) may be broadcast.
BROADCAST_ROWS = 1_000_000

# What a row costs, relative to a joined and summed pair: a pair inside a tile, a rating sent to one.
PAIR_COST, TILE_PAIR_COST, SENT_COST = 1.0, 0.05, 3.0


@dataclass(frozen=True)
class Fitted:
    """User vectors of a training frame, staged once.

    ``vectors``   user_id, item_id, dev, pdev, n_rated, tiled, hot
    ``users``     user_id, user_mean, n_rated, norm, tiled: one row per user
    ``hot_items`` item_id of the hot items, or None if there are none

    * hot: the item has too many raters to join them with each other, and more than there would be blocks;
    * tiled: the user rated a hot item, so pairs of tiled users are compared in
      tiles.  Two users who are not both tiled share no hot item, except with a user
      whose own rating count is over ``tiled_user_ratings``; of those there can be
      only few.

    ``long_groups`` tells whether a user's or a cell's list of partners can be longer
    than the settings allow in one sorted group.

    A saved model (operators.store) also has its rows bucketed: ``light``, those of items that are not hot, by
    item, and ``by_user``, all of them, if no user's list is long.
    """

    vectors: DataFrame
    users: DataFrame
    hot_items: DataFrame | None
    long_groups: bool
    settings: FitSettings
    bounds: RatingScale
    light: DataFrame | None = None
    by_user: DataFrame | None = None


def flag_hot(rows: DataFrame, hot_items: DataFrame, count: int) -> DataFrame:
    """Add ``hot``; the list is broadcast only if its counted length allows it."""
    marked = hot_items.withColumn("hot", F.lit(True))
    if count <= BROADCAST_ROWS:
        marked = F.broadcast(marked)
    return rows.join(marked, "item_id", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


def one_rating_each(ratings: DataFrame) -> DataFrame:
    """One row per (user, item): the mean of its ratings.  Rows with a null are left out."""
    known = ratings.dropna(subset=["user_id", "item_id", "rating"])
    return known.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))


def fit(
    ratings: DataFrame,
    settings: FitSettings = FitSettings(),
    bounds: RatingScale = RatingScale(),
    means: DataFrame | None = None,
    stored: bool = False,
) -> Fitted:
    """Compute and stage the vectors of ``ratings``.

    ``means`` replaces the user means of ``ratings`` by given ones: deviations of
    held-out rows around training means, for example.

    A user's vector has one entry per item: rows that repeat a (user, item) count as
    one rating, their mean, and rows with a null user, item or rating are left out (``one_rating_each``).

    The ratings are staged first, because they are read several times and whatever
    joins and aggregates produce them should run once; ``stored=True`` says that they
    are a scan of a stored table of one rating per (user, item) already.  Counting the hot items
    then tells which branches later plans need at all.
    """
    ratings = ratings.select("user_id", "item_id", "rating")
    if not stored:
        ratings = stage(one_rating_each(ratings), "ratings")
    degrees = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    if settings.hot_item_ratings is None:
        settings = replace(settings, hot_item_ratings=split_at(degrees, ratings, settings))
    busy = degrees.where(F.col("n") > settings.hot_item_ratings)
    hot_items = busy.where(F.col("n") > most_blocks(busy, ratings, settings)).select("item_id")
    hot_items = stage(hot_items, "hot-items")
    hot_count = hot_items.count()
    hot_items = hot_items if hot_count else None
    users, vectors, long_lists = fit_users(ratings, hot_items, hot_count, settings, bounds, means)
    return Fitted(vectors, users, hot_items, bool(hot_count) or long_lists, settings, bounds)


def fit_users(
    ratings: DataFrame, hot_items: DataFrame | None, hot_count: int, settings: FitSettings,
    bounds: RatingScale, means: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, bool]:
    """Users and vectors of stored ratings under a given set of hot items, and whether a user's list is long.

    A user's vector depends on that user's ratings alone.
    """
    users = user_profiles(ratings, bounds, means)
    if hot_items is not None:
        rated_hot = (
            flag_hot(ratings, hot_items, hot_count)
            .where("hot").select("user_id", F.lit(True).alias("rated_hot")).distinct()
        )
        short_enough = F.col("n_rated") <= settings.tiled_user_ratings
        users = users.join(rated_hot, "user_id", "left").withColumn(
            "tiled", F.col("rated_hot").isNotNull() & short_enough
        ).drop("rated_hot")
    else:
        users = users.withColumn("tiled", F.lit(False))
    users = stage(users, "users")
    long_lists = not users.where(F.col("n_rated") > settings.tiled_user_ratings).isEmpty()

    vectors = processed_deviations(ratings, users, bounds).drop("rating", "user_mean")
    if hot_items is not None:
        vectors = flag_hot(vectors, hot_items, hot_count)
    else:
        vectors = vectors.withColumn("hot", F.lit(False))
    return users, stage(vectors, "vectors"), long_lists


def most_blocks(busy: DataFrame, ratings: DataFrame, settings: FitSettings) -> Column:
    """The blocks that the ratings of all ``busy`` items would make, as a scalar.

    A hot rating is sent to every block, a joined one to the other raters of its item: an item with no more raters than
    blocks costs less joined.  So what is sent to tiles never grows with the square of the users alone.
    """
    users = ratings.agg(F.approx_count_distinct("user_id")).scalar()
    sent = F.coalesce(F.sum("n"), F.lit(0))
    return busy.agg(F.ceil(F.greatest(F.least(users, sent) / settings.tile_users, sent / settings.tile_ratings))).scalar()


def split_at(degrees: DataFrame, ratings: DataFrame, settings: FitSettings) -> int:
    """The number of ratings up to which an item's raters are best joined with each other.

    The cost of a split is a sum over the histogram of item degrees d: joined items cost a row for each of their
    d * (d - 1) / 2 pairs; items in tiles cost d ratings sent to every block, and their pairs at numpy's rate.  The number
    of blocks follows from the ratings in tiles.  The histogram has a row for each different degree, so at most the root of
    twice the ratings; its running totals are formed in one task.
    """
    pairs = F.col("items") * F.col("d") * (F.col("d") - 1) / 2
    histogram = degrees.groupBy(F.col("n").alias("d")).agg(F.count(F.lit(1)).alias("items"))
    upto = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, -1)
    users = ratings.agg(F.approx_count_distinct("user_id")).scalar()
    totals = histogram.select(
        "d", F.sum(pairs).over(upto).alias("joined"),
        F.coalesce(F.sum(pairs).over(beyond), F.lit(0.0)).alias("tile_pairs"),
        F.coalesce(F.sum(F.col("items") * F.col("d")).over(beyond), F.lit(0)).alias("sent"),
    )
    blocks = F.ceil(F.greatest(F.least(users, "sent") / settings.tile_users, F.col("sent") / settings.tile_ratings))
    cost = PAIR_COST * F.col("joined") + TILE_PAIR_COST * F.col("tile_pairs") + SENT_COST * F.col("sent") * blocks
    least = totals.agg(F.min_by("d", F.struct(cost, "d"))).first()[0]
    return settings.tile_users if least is None else int(least)

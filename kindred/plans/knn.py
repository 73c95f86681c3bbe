"""Neighbourhood models: fit on training ratings, predict and evaluate on others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators import lists, pairs
from kindred.operators.metrics import absolute_errors
from kindred.operators.neighbors import from_top_k, top_k, top_k_of
from kindred.operators.vectors import Fitted
from kindred.operators.weighting import (
    all_neighbor_sums, full_table_sums, knn_sums, nearest_sums, nearest_sums_for_ks, neighbor_terms,
    predict, weighted_prediction, with_user_means,
)
from kindred.schema import SWEEP_KS

# Width of the k ranges in which running totals over k are formed separately.
K_RANGE = 65_536


def predict_all_neighbors(
    fitted: Fitted, test: DataFrame, metric: str = pairs.COSINE, fallback: str = "user_mean"
) -> DataFrame:
    return predict(test, all_neighbor_sums(test, fitted, metric), fitted, fallback)


def predict_knn(
    fitted: Fitted,
    test: DataFrame,
    k: int,
    metric: str = pairs.COSINE,
    fallback: str = "user_mean",
) -> DataFrame:
    """Predictions from the k most similar users; neighbours are found for all users."""
    return predict(test, nearest_sums(test, fitted, k, metric), fitted, fallback)


def predict_knn_for(
    fitted: Fitted, test: DataFrame, k: int, fallback: str = "user_mean"
) -> DataFrame:
    """The same for a test frame with few users: only their neighbours are looked for."""
    neighbors = top_k_of(fitted, test.select("user_id").distinct(), k)
    return predict(test, knn_sums(test, neighbors, fitted), fitted, fallback)


def predict_table(fitted: Fitted, k: int, metric: str = pairs.COSINE) -> DataFrame:
    """Predictions for all cells with a usable neighbour among the k nearest."""

    def predicted(neighbors: DataFrame) -> DataFrame:
        return (
            with_user_means(full_table_sums(neighbors, fitted), fitted)
            .select(
                "user_id", "item_id",
                weighted_prediction(
                    F.col("num"), F.col("den"), F.col("user_mean"), fitted.bounds, "drop"
                ).alias("prediction"),
            )
            .where(F.col("prediction").isNotNull())
        )

    return from_top_k(fitted, k, predicted, metric)


def knn_sweep(
    fitted: Fitted,
    test: DataFrame,
    ks: tuple[int, ...] = SWEEP_KS,
    metric: str = pairs.COSINE,
    fallback: str = "user_mean",
) -> DataFrame:
    """MAE for several k in one job: neighbours are ranked once, at the largest k."""
    ks = sorted(set(ks))
    sums = nearest_sums_for_ks(test, fitted, ks, metric)
    mean = F.col("user_mean")
    per_k = F.explode(F.array(*[
        F.struct(
            F.lit(k).alias("k"),
            weighted_prediction(
                F.col(f"num_{k}"), F.col(f"den_{k}"), mean, fitted.bounds, fallback
            ).alias("prediction"),
        )
        for k in ks
    ]))
    predicted = (
        with_user_means(test, fitted)
        .join(sums, ["user_id", "item_id"], "left")
        .select("rating", per_k.alias("p"))
        .select("rating", "p.k", "p.prediction")
    )
    return absolute_errors(predicted).groupBy("k").agg(
        F.count("error").alias("n"), F.avg("error").alias("mae")
    )


def edges_by_k(
    fitted: Fitted, ks: tuple[int, ...] = SWEEP_KS, metric: str = pairs.COSINE
) -> DataFrame:
    """How many similarities a k-nearest-neighbour table holds, and their bytes at 8 each."""
    ks = sorted(set(ks))
    counts = from_top_k(fitted, ks[-1], lambda neighbors: neighbors.agg(
        *[F.count_if(F.col("rank") <= k).alias(f"edges_{k}") for k in ks]
    ), metric)
    ranked = counts.agg(*[F.sum(f"edges_{k}").alias(f"edges_{k}") for k in ks])
    per_k = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"edges_{k}").alias("edges")) for k in ks
    ]))
    return ranked.select(per_k.alias("e")).select(
        "e.k", "e.edges", (F.col("e.edges") * 8).alias("bytes")
    )


def mae_by_k(
    fitted: Fitted, test: DataFrame, metric: str = pairs.COSINE, fallback: str = "user_mean"
) -> DataFrame:
    """k, n, mae at every k where the MAE can change, and at k = 1; one job for all k.

    A test row's prediction changes only at the rank of a neighbour that rated the
    item.  The change of its error there is booked to that k; adding the bookings up
    in order of k gives the total error at every k.  The running total is formed in
    ranges of k first, so that no task sees all of them.
    """
    known = with_user_means(test, fitted)

    def error(num: str, den: str) -> Column:
        return F.abs(F.col("rating") - weighted_prediction(
            F.col(num), F.col(den), F.col("user_mean"), fitted.bounds, fallback
        ))

    def booked(steps: DataFrame) -> DataFrame:
        changed = steps.select(
            "k", error("num", "den").alias("after"), error("num_before", "den_before").alias("before")
        )
        return changed.select(
            "k",
            (F.coalesce("after", F.lit(0.0)) - F.coalesce("before", F.lit(0.0))).alias("error"),
            (F.col("after").isNotNull().cast("bigint") - F.col("before").isNotNull().cast("bigint")).alias("n"),
        )

    def summed(bookings: DataFrame) -> DataFrame:
        return bookings.groupBy("k").agg(F.sum("error").alias("error"), F.sum("n").alias("n"))

    if parts := lists.part_count(fitted):
        cells = known.select("user_id", "item_id", "rating", "user_mean")
        bookings = lists.list_steps(
            pairs.usable(fitted.vectors, metric), fitted, metric, cells, parts, lambda steps: summed(booked(steps))
        )
    else:
        ranked = top_k(fitted, None, metric).select("user_id", "neighbor_id", "similarity", "rank")
        cells = test.select("user_id", "item_id").distinct()
        terms = neighbor_terms(cells, ranked, fitted).select(
            "user_id", "item_id", F.col("rank").cast("bigint").alias("k"),
            (F.col("similarity") * F.col("dev")).alias("num"), F.abs("similarity").alias("den"),
        )
        bookings = booked(known.join(
            running_totals(terms, ["user_id", "item_id"], ["num", "den"], fitted.long_groups), ["user_id", "item_id"]
        ))
    if fallback == "user_mean":
        base = known.agg(
            F.lit(1).cast("bigint").alias("k"),
            F.sum(F.abs(F.col("rating") - F.col("user_mean"))).alias("error"),
            F.count(F.lit(1)).alias("n"),
        )
        bookings = bookings.unionByName(base)
    return running_totals(summed(bookings), [], ["error", "n"], True).select(
        "k", "n", F.try_divide(F.col("error"), F.col("n")).alias("mae")
    )


def running_totals(
    rows: DataFrame, keys: list[str], columns: list[str], in_ranges: bool
) -> DataFrame:
    """Sums of ``columns`` over k, up to each row and (``_before``) up to the row before.

    ``in_ranges`` forms them in ranges of k first, so that no task sees all rows of a
    key; the totals of whole ranges are few.
    """
    if in_ranges:
        rows = rows.withColumn("range", F.floor(F.col("k") / K_RANGE))
    group = [*keys, "range"] if in_ranges else keys
    inside = Window.partitionBy(*group).orderBy("k")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.select(
        *group, "k",
        *[F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in columns],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns],
    )
    if not in_ranges:
        return totals
    ranges = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*group).agg(*[F.sum(c).alias(c) for c in columns]).select(
        *group,
        *[F.coalesce(F.sum(c).over(ranges), F.lit(0)).alias(f"{c}_offset") for c in columns],
    )
    return totals.join(offsets, group).select(
        *keys, "k",
        *[(F.col(c) + F.col(f"{c}_offset")).alias(c) for c in columns],
        *[(F.col(f"{c}_before") + F.col(f"{c}_offset")).alias(f"{c}_before") for c in columns],
    )


def lowest_k(curve: DataFrame, target: DataFrame) -> DataFrame:
    """Smallest k whose MAE is below the target's: one row, k and MAE NULL if none is.

    ``curve`` comes from :func:`mae_by_k`, ``target`` is a metrics row.
    """
    goal = target.select("mae").scalar()
    hit = F.struct("k", "mae")
    return (
        curve.agg(F.min(F.when(F.col("mae") < goal, hit)).alias("hit"))
        .select(goal.alias("target_mae"), F.col("hit.k").alias("k"), F.col("hit.mae").alias("mae"))
    )

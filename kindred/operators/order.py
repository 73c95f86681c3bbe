"""Ranks of whole orders, where one list may be too long to sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.sources.staging import stage


def rank_in_ranges(rows: DataFrame, order: list[Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``rank`` (from 1) by ``order`` within each group ``by``, or over all rows.

    Rows are cut into ranges of the whole order of ``by`` and ``order``, at places that Spark samples from
    the rows, so ranges are of even size whatever the values are; rows tied in the first
    expressions are divided by the later ones.  A rank is the place inside the range plus
    the rows of the group in lower ranges; what is known of ranges is one count for each group
    in each.  The ranged rows are staged, so both see the same ranges.  ``order`` should be unique
    within a group; which of two equal rows comes first is not defined.
    """
    ranged = rows.repartitionByRange(*[F.asc(c) for c in by], *order).withColumn("__range", F.spark_partition_id())
    ranged = stage(ranged, "ranged")
    inside = Window.partitionBy(*by, "__range").orderBy(*order)
    counts = ranged.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("c"))
    sizes = counts.groupBy(*by).agg(F.collect_list(F.struct("__range", "c")).alias("sizes"))
    # At most one entry for each range.
    lower = lambda own: F.aggregate(
        F.filter("sizes", lambda other: other["__range"] < own["__range"]), F.lit(0).cast("bigint"), lambda acc, x: acc + x["c"]
    )
    ahead = sizes.select(*by, F.explode(F.transform(
        "sizes", lambda own: F.struct(own["__range"].alias("__range"), lower(own).alias("__ahead"))
    )).alias("own")).select(*by, "own.*")
    placed = ranged.withColumn("__at", F.row_number().over(inside))
    keys = [*by, "__range"]
    same = [placed[c].eqNullSafe(ahead[c]) for c in keys]
    return placed.join(ahead, same).select(
        *[placed[c] for c in rows.columns], (F.col("__at") + F.col("__ahead")).cast("bigint").alias("rank")
    )

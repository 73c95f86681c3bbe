"""Item sets of groups of users as bitmaps.

A set is held as one bitmap of 32,768 items for each bucket of item ids that it touches.  Bitmaps of
a group combine before the shuffle, unions and sizes of groups need neither a distinct count
nor a row for each member, and sets made once answer for any grouping of their groups.
They suit groups with many items (a bitmap has 4 KB); the sets of single users are rows
(``stats.item_sets``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_bitmaps(rows: DataFrame, by: str) -> DataFrame:
    """``by``, bucket, items: which items occur in the rows (``by``, item_id) of each group.

    Rows without an item are left out; rows without a group form one of their own.
    """
    known = rows.where(F.col("item_id").isNotNull())
    bucket = F.bitmap_bucket_number(F.col("item_id")).alias("bucket")
    return known.groupBy(by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("item_id"))).alias("items"))


def united(bitmaps: DataFrame, by: str) -> DataFrame:
    """The unions of bitmaps (``by``, bucket, items), by a coarser group."""
    return bitmaps.groupBy(by, "bucket").agg(F.bitmap_or_agg("items").alias("items"))


def set_sizes(bitmaps: DataFrame, by: str) -> DataFrame:
    """``by``, set_size: how many items each group's set has."""
    return bitmaps.groupBy(by).agg(F.sum(F.bitmap_count("items")).alias("set_size"))


def set_overlaps(bitmaps: DataFrame, by: str, wanted: DataFrame) -> DataFrame:
    """a, b, shared, joint, jaccard for each pair of groups (a, b) in ``wanted``.

    A pair's bitmaps meet by bucket: what both count, less what their union counts, is shared.
    Pairs with a group that has no items, or with one group twice, are left out.
    """
    wanted = wanted.where("a <> b").distinct()
    ends = wanted.select("a", "b", F.explode(F.array("a", "b")).alias(by))
    met = ends.join(bitmaps, by).groupBy("a", "b", "bucket").agg(
        F.bitmap_or_agg("items").alias("items"), F.sum(F.bitmap_count("items")).alias("counted"),
        F.max((F.col(by) == F.col("a")).cast("int")).alias("in_a"), F.max((F.col(by) == F.col("b")).cast("int")).alias("in_b"),
    )
    sums = met.groupBy("a", "b").agg(
        F.sum("counted").alias("counted"), F.sum(F.bitmap_count("items")).alias("joint"), F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b")
    )
    shared = F.col("counted") - F.col("joint")
    return sums.where("in_a = 1 and in_b = 1").select("a", "b", shared.alias("shared"), "joint", (shared / F.col("joint")).alias("jaccard"))

"""Ratings derived from a sales star schema (orders, lineitem, part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ratings_from_sales(spark: SparkSession, directory: str) -> DataFrame:
    """Customers rate parts: the mean of ceil(quantity / 10), which lies in [1, 5].

    The join reads two columns of each fact table.  Purchases of one part by one
    customer are combined map-side before they are shuffled.
    """
    lines = _table(spark, directory, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = _table(spark, directory, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.avg(F.ceil(F.col("l_quantity") / 10).cast("double")).alias("rating"))
    )


def _fold(folds: int):
    return F.pmod(F.col("user_id") * 31 + F.col("item_id") * 17, F.lit(folds))


def train_test(ratings: DataFrame, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Split ratings into train and held-out test; together they are all rows.

    The fold depends on the keys only, so the split is the same on every run and
    both filters are pushed below the aggregate that builds the ratings.
    """
    return ratings.where(_fold(folds) != 0), ratings.where(_fold(folds) == 0)


def personal_from_parts(spark: SparkSession, directory: str) -> DataFrame:
    """A personal rating list over the part catalogue: item_id, title, rating or NULL."""
    part = _table(spark, directory, "part")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_partkey") % 7 == 1, (1 + F.col("p_partkey") % 5).cast("double")).alias("rating"),
    )


def item_titles(spark: SparkSession, directory: str) -> DataFrame:
    return _table(spark, directory, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title")
    )

"""Delimited-text sources.

Every field is read as text and cast afterwards: Spark's CSV reader would turn a
malformed number into NULL, whereas an ANSI cast fails the job, which is what a
fixed-schema ratings file calls for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text_columns(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _required(name: str, kind: str) -> Column:
    """A field cast to ``kind``; a line that lacks it fails the job, like one that can't be cast."""
    missing = F.raise_error(F.lit(f"a line of the ratings file has no {name}"))
    return F.when(F.col(name).isNull(), missing).otherwise(F.col(name)).cast(kind).alias(name)


def read_ratings(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Ratings from ``user <sep> item <sep> rating [<sep> anything]`` lines."""
    raw = spark.read.csv(
        path,
        schema=_text_columns("user_id", "item_id", "rating"),
        sep=sep,
        quote="",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )
    return raw.select(
        _required("user_id", "bigint"), _required("item_id", "bigint"), _required("rating", "double")
    )


def read_personal(spark: SparkSession, path: str) -> DataFrame:
    """``item_id, title, rating`` from a CSV; rating is NULL where left empty.

    Titles that contain a comma must be quoted.
    """
    raw = spark.read.csv(
        path,
        schema=_text_columns("item_id", "title", "rating"),
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )
    return raw.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        "title",
        F.nullif(F.trim("rating"), F.lit("")).cast("double").alias("rating"),
    )


def personal_ratings(personal: DataFrame, user_id: int) -> DataFrame:
    """The rated rows of a personal file as ratings of ``user_id``."""
    return personal.where(F.col("rating").isNotNull()).select(
        F.lit(user_id).cast("bigint").alias("user_id"), "item_id", "rating"
    )

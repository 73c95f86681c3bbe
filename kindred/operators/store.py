"""Fitted models that outlive their job, and changes of single users.

A saved model is a folder: ``light`` (rows of items that are not hot, bucketed and sorted by item), ``hot`` (the other rows),
``by_user`` (all rows, bucketed and sorted by user, unless a user's list is long), ``users`` (bucketed by user),
``hot_items`` and ``model`` (one JSON line).  Joins on a bucketed column need no shuffle of the model.  Hot items and
long lists stay out of buckets, which one task reads.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.vectors import Fitted, fit_users, one_rating_each
from kindred.schema import FitSettings, RatingScale
from kindred.sources.staging import shuffles_removed, stage

BUCKETED = {"light": "item_id", "by_user": "user_id", "users": "user_id"}


def _table(spark: SparkSession, path: str, name: str, schema: str, buckets: int) -> DataFrame:
    """A bucketed folder as a table of this session's catalog, which knows its buckets; files stay where they are."""
    table = f"kindred_{name}_{uuid.uuid4().hex}"
    column = BUCKETED[name]
    spark.sql(
        f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({column}) SORTED BY ({column}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/{name}'"
    )
    df = spark.table(table)
    df.kindred_table = table
    return df


def save(fitted: Fitted, path: str, buckets: int | None = None) -> None:
    """Write a model to a new folder.  ``buckets``: the session's number of shuffle partitions unless given; a
    session with more partitions than buckets may shuffle the model after all."""
    spark = fitted.vectors.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    long_lists = not fitted.users.where(F.col("n_rated") > fitted.settings.tiled_user_ratings).isEmpty()
    frames = {"light": fitted.vectors.where("not hot"), "users": fitted.users}
    if not long_lists:
        frames["by_user"] = fitted.vectors
    for name, df in frames.items():
        table, column = f"kindred_{name}_{uuid.uuid4().hex}", BUCKETED[name]
        writer = df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
        with shuffles_removed(spark):
            writer.option("path", f"{path}/{name}").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    fitted.vectors.where("hot").write.parquet(f"{path}/hot")
    if fitted.hot_items is not None:
        fitted.hot_items.write.parquet(f"{path}/hot_items")
    about = {
        "settings": asdict(fitted.settings), "bounds": asdict(fitted.bounds), "buckets": buckets,
        "hot_items": fitted.hot_items is not None, "long_groups": fitted.long_groups, "by_user": not long_lists,
        "schemas": {name: ", ".join(f"`{c}` {t}" for c, t in df.dtypes) for name, df in frames.items()},
    }
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/model")


def load(spark: SparkSession, path: str) -> Fitted:
    """The model that ``save`` wrote to ``path``, in any session.  ``unload`` takes its tables out of the catalog."""
    about = json.loads(spark.read.text(f"{path}/model").first()[0])
    tables = {name: _table(spark, path, name, schema, about["buckets"]) for name, schema in about["schemas"].items()}
    vectors = light = tables["light"]
    hot_items = None
    if about["hot_items"]:
        vectors = light.unionByName(spark.read.schema(light.schema).parquet(f"{path}/hot"))
        hot_items = spark.read.schema("item_id bigint").parquet(f"{path}/hot_items")
    return Fitted(
        vectors, tables["users"], hot_items, about["long_groups"], FitSettings(**about["settings"]),
        RatingScale(**about["bounds"]), light, tables.get("by_user"),
    )


def unload(fitted: Fitted) -> None:
    """Forget the catalog's entries of a loaded model; its folder stays.  Plans that read it must have run."""
    for df in (fitted.light, fitted.by_user, fitted.users):
        if hasattr(df, "kindred_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.kindred_table}")


def fold_in(fitted: Fitted, ratings: DataFrame, removed: DataFrame | None = None) -> Fitted:
    """The model after some users changed, without fitting the others again.

    ``ratings``: all ratings of the users that are new or changed; what the model had of them is replaced.  ``removed`` (user_id):
    users whose old rows go.  The result equals a fit of all resulting ratings: a user's vector depends on its own
    ratings alone.  Which items are hot stays as fitted, as that only divides the work; after many changes fit anew.  Only the
    changed users are computed; the other rows are read where they are and filtered by the changed ids.
    """
    rows = stage(one_rating_each(ratings.select("user_id", "item_id", "rating")), "folded")
    changed = rows.select("user_id")
    if removed is not None:
        changed = changed.unionByName(removed.select("user_id").where("user_id is not null"))
    changed = stage(changed.distinct(), "changed")
    hot_count = fitted.hot_items.count() if fitted.hot_items is not None else 0
    users, vectors, long_lists = fit_users(rows, fitted.hot_items, hot_count, fitted.settings, fitted.bounds)
    merged = lambda old, new: old.join(changed, "user_id", "left_anti").unionByName(new)
    return replace(
        fitted, vectors=merged(fitted.vectors, vectors.select(*fitted.vectors.columns)),
        users=merged(fitted.users, users.select(*fitted.users.columns)),
        long_groups=fitted.long_groups or long_lists, light=None, by_user=None,
    )

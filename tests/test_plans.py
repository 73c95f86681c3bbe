"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from kindred.operators import pairs
from kindred.operators.deviations import deviations
from kindred.operators.neighbors import top_k
from kindred.operators.stats import user_means
from kindred.operators.vectors import fit
from kindred.plans.baseline import predict_baseline
from kindred.plans.knn import knn_sweep, predict_all_neighbors, predict_knn
from kindred.plans.recommend import recommend_knn_all
from kindred.schema import FitSettings
from kindred.sources import ratings_from_sales, stage, train_test


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def split(spark, small_dir):
    return train_test(stage(ratings_from_sales(spark, small_dir), "ratings"))


@pytest.fixture(scope="module")
def fitted(split):
    return fit(split[0], stored=True)


def test_sources_read_only_their_columns(spark, small_dir):
    plan = plan_of(ratings_from_sales(spark, small_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_no_cross_join_and_no_python_without_hot_items(split, fitted):
    test = split[1]
    for df in (
        predict_baseline(*split), pairs.similarity_pairs(fitted), predict_knn(fitted, test, 10),
        predict_all_neighbors(fitted, test), knn_sweep(fitted, test), recommend_knn_all(fitted, 10),
    ):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "Pandas" not in plan and "Python" not in plan


def test_recommendations_for_a_constant_user_join_on_a_key(spark, small_dir):
    from verification.queries import QUERIES

    plan = plan_of(QUERIES["recommend_knn"](spark, small_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_top_k_of_short_lists_shuffles_edges_once(fitted):
    plan = plan_of(top_k(fitted, 5))
    assert plan.count("WindowGroupLimit") == 1
    above_join = plan[: plan.index("Join")]
    assert above_join.count("Exchange") == 1


def test_top_k_of_long_lists_is_limited_before_its_shuffle(split):
    long_lists = fit(split[0], FitSettings(tiled_user_ratings=20), stored=True)
    assert long_lists.long_groups
    assert plan_of(top_k(long_lists, 5)).count("WindowGroupLimit") == 2


def test_hot_items_are_tiled(split):
    hot = fit(split[0], FitSettings(hot_item_ratings=20), stored=True)
    plan = plan_of(top_k(hot, 5))
    assert "FlatMapCoGroupsInPandas" in plan and "CartesianProduct" not in plan


def test_self_join_shuffles_the_vectors_once(spark, fitted):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = pairs.joined_pairs(fitted, pairs.COSINE)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "ReusedExchange" in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def test_adaptive_execution_can_split_a_hot_user(spark, split):
    """A join with per-user means: plain it stays in one task, salted it is split."""
    before = {name: spark.conf.get(name) for name in SKEW if spark.conf.get(name, None)}
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    try:
        hot = spark.range(300_000).select(
            F.lit(-9).cast("bigint").alias("user_id"),
            (F.col("id") + 10**6).alias("item_id"),
            (1 + F.col("id") % 5).cast("double").alias("rating"),
        )
        ratings = stage(split[0].unionByName(hot).repartition(8), "skewed")
        means = user_means(ratings)
        salted = deviations(ratings, means).groupBy("item_id").agg(F.avg("dev"))
        plain = ratings.join(means, "user_id").groupBy("item_id").agg(F.avg("rating"))
        for df, is_split in ((salted, True), (plain, False)):
            df.collect()
            assert ("skew=true" in plan_of(df)) == is_split
    finally:
        for name in SKEW:
            spark.conf.set(name, before[name]) if name in before else spark.conf.unset(name)

"""Text and CSV sources, validation, staging and the JSON sink."""

import pytest
from pyspark.sql import functions as F

from kindred.sources import (
    expect_count, personal_ratings, ratings_from_sales, read_personal, read_ratings, stage,
    train_test, write_json,
)
from kindred.sources.staging import checkpoint_folder


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sep", ["\t", "::", ","])
def test_ratings_with_any_separator(spark, tmp_path, sep):
    lines = [["1", "10", "5", "881250949"], [" 2 ", "11", " 3.5", "881250950"], ["3", "12", "1"]]
    (tmp_path / "r.txt").write_text("\n".join(sep.join(x) for x in lines) + "\n")
    found = read_ratings(spark, str(tmp_path / "r.txt"), sep)
    assert rows(found) == [(1, 10, 5.0), (2, 11, 3.5), (3, 12, 1.0)]
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "double"]


def test_bad_number_fails(spark, tmp_path):
    (tmp_path / "r.txt").write_text("1\t10\tfive\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_ratings(spark, str(tmp_path / "r.txt")).collect()


def test_personal_ratings(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        '1,Plain Title (1995),4\n2,"Comma, The (1996)",\n3,"Both, A (1997)",2.5\n4,Unrated (1998),\n'
    )
    personal = read_personal(spark, str(tmp_path / "p.csv"))
    assert sorted((r.item_id, r.title, r.rating) for r in personal.collect()) == [
        (1, "Plain Title (1995)", 4.0), (2, "Comma, The (1996)", None),
        (3, "Both, A (1997)", 2.5), (4, "Unrated (1998)", None),
    ]
    assert rows(personal_ratings(personal, 944)) == [(944, 1, 4.0), (944, 3, 2.5)]


def test_expect_count(spark):
    df = spark.range(7)
    assert expect_count(df, 7) is df
    with pytest.raises(ValueError, match="expected 8 ratings, found 7"):
        expect_count(df, 8, "ratings")


def test_split_covers_everything_once(spark, small_dir):
    ratings = ratings_from_sales(spark, small_dir)
    train, test = train_test(ratings)
    assert train.count() + test.count() == ratings.count() == 5382
    assert test.count() == 1081
    assert train.join(test, ["user_id", "item_id"]).count() == 0
    bounds = ratings.agg(F.min("rating"), F.max("rating")).first()
    assert 1 <= bounds[0] and bounds[1] <= 5


def test_stage_uses_the_configured_folder(spark):
    staged = stage(spark.range(5), "numbers")
    path = staged.inputFiles()[0]
    assert checkpoint_folder(spark) in path and checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert rows(staged) == [(i,) for i in range(5)]


def test_json_sink(spark, tmp_path):
    metrics = spark.createDataFrame([("a", 3, 0.5), ("b", 4, 0.25)], "model string, n bigint, mae double")
    write_json(metrics, str(tmp_path / "m"))
    assert rows(spark.read.schema(metrics.schema).json(str(tmp_path / "m"))) == rows(metrics)
    with pytest.raises(Exception, match="already exists"):
        write_json(metrics, str(tmp_path / "m"))


def test_staging_leaves_no_shuffle_files(spark):
    """They stayed until the driver's heap was collected, beside the table they had made."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = lambda: {str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",") if "shuffle_" in f}
    before, setting = disk(), spark.conf.get(key)
    staged = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "grouped")
    assert disk() <= before and staged.count() == 7 and spark.conf.get(key) == setting

"""Hand-checked values on the tiny fixture."""

import pytest
from pyspark.sql import functions as F

from kindred.operators import pairs
from kindred.operators.deviations import deviations, item_deviations, processed_deviations, user_profiles
from kindred.operators.metrics import compare, mae
from kindred.operators.stats import item_means, user_means
from kindred.operators.vectors import fit
from kindred.plans.baseline import predict_baseline, predict_user_mean
from kindred.plans.knn import predict_all_neighbors, predict_knn
from kindred.schema import FitSettings

SETTINGS = [FitSettings(), FitSettings(hot_item_ratings=2, tile_users=1)]


def by_pair(df, value):
    return {(r[0], r[1]): r[value] for r in df.collect()}


def test_means_and_deviations(tiny):
    train, _ = tiny
    means = {r.user_id: r.user_mean for r in user_means(train).collect()}
    assert means == pytest.approx({1: 3, 2: 11 / 3, 3: 3, 4: 4})
    devs = by_pair(deviations(train, user_means(train)), "dev")
    assert devs == pytest.approx({
        (1, 10): 1, (1, 11): 0, (1, 12): -1, (2, 10): 0.25, (2, 11): -0.625, (2, 13): 1,
        (3, 10): -1, (3, 12): 1, (3, 13): 0, (4, 11): 0, (4, 12): 0,
    })
    items = {r.item_id: r.item_dev for r in item_deviations(deviations(train, user_means(train))).collect()}
    assert items == pytest.approx({10: 1 / 12, 11: -0.625 / 3, 12: 0, 13: 0.5})
    assert {r.item_id: r.n for r in item_means(train).collect()} == {10: 3, 11: 3, 12: 3, 13: 2}


def test_profiles_and_zero_norm(tiny):
    train, _ = tiny
    norms = {r.user_id: r.norm for r in user_profiles(train).collect()}
    assert norms == pytest.approx({1: 2**0.5, 2: 1.2054563451241194, 3: 2**0.5, 4: 0})
    rows = processed_deviations(train, user_profiles(train)).where("user_id = 4").collect()
    assert all(r.pdev is None and r.dev == 0 for r in rows)


@pytest.mark.parametrize("settings", SETTINGS)
def test_similarities(tiny, settings):
    fitted = fit(tiny[0], settings)
    assert by_pair(pairs.similarity_pairs(fitted, "cosine"), "similarity") == pytest.approx(
        {(1, 2): 0.146647115, (1, 3): -1, (2, 3): -0.146647115}
    )
    assert by_pair(pairs.similarity_pairs(fitted, "jaccard"), "similarity") == pytest.approx({
        (1, 2): 0.5, (1, 3): 0.5, (1, 4): 0.666666667, (2, 3): 0.5, (2, 4): 0.25, (3, 4): 0.25,
    })
    assert by_pair(pairs.similarity_pairs(fitted, "overlap"), "similarity") == {
        (1, 2): 2, (1, 3): 2, (1, 4): 2, (2, 3): 2, (2, 4): 1, (3, 4): 1,
    }


@pytest.mark.parametrize("settings", SETTINGS)
def test_predictions_and_mae(tiny, settings):
    train, test = tiny
    baseline = predict_baseline(train, test)
    assert by_pair(baseline.select("user_id", "item_id", "prediction"), "prediction") == pytest.approx({
        (1, 13): 4, (1, 14): 3, (2, 12): 11 / 3, (3, 11): 2.583333, (4, 10): 4.083333,
    }, abs=1e-6)
    fitted = fit(train, settings)
    cosine = predict_all_neighbors(fitted, test)
    assert by_pair(cosine, "prediction") == pytest.approx({
        (1, 13): 3.255784, (1, 14): 3, (2, 12): 1, (3, 11): 3.159865, (4, 10): 4,
    }, abs=1e-6)
    rows = (
        mae(predict_user_mean(train, test), "user")
        .unionByName(mae(baseline, "baseline"))
        .unionByName(mae(cosine, "cosine"))
    )
    found = {r.model: r for r in compare(rows, "baseline").collect()}
    assert {m: r.mae for m, r in found.items()} == pytest.approx(
        {"user": 0.933333, "baseline": 0.833333, "cosine": 0.71687}, abs=1e-5
    )
    assert found["cosine"].mae_minus_reference == pytest.approx(0.71687 - 0.833333, abs=1e-5)
    assert all(r.n == 5 for r in found.values())


def test_fallback_drop_counts_only_covered_rows(tiny):
    train, test = tiny
    row = mae(predict_all_neighbors(fit(train), test, fallback="drop"), "cosine").first()
    assert row.n == 3
    cold = predict_baseline(train, test, cold_items="drop")
    assert cold.where(F.col("item_id") == 14).count() == 0
    with pytest.raises(ValueError):
        predict_baseline(train, test, cold_items="other")
    with pytest.raises(ValueError):
        predict_knn(fit(train), test, 1, fallback="other")


def test_unknown_user_is_left_out(tiny, spark):
    train, _ = tiny
    stranger = spark.createDataFrame([(99, 10, 3.0)], train.schema)
    assert predict_knn(fit(train), stranger, 2).count() == 0


def test_equal_ratings_have_zero_norm(spark):
    """Three times 7/3 does not sum to exactly 7 in floating point."""
    rows = [(1, i, 7 / 3) for i in range(11)] + [(2, i, float(1 + i % 5)) for i in range(11)]
    fitted = fit(spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double"))
    assert pairs.similarity_pairs(fitted, "cosine").count() == 0
    assert pairs.similarity_pairs(fitted, "jaccard").first().similarity == 1.0

"""Hot items and hot users: tiles, pair join and brute force must agree."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import pairs, tiles
from kindred.operators.neighbors import top_k
from kindred.operators.vectors import fit
from kindred.plans import knn
from kindred.plans.knn import (
    knn_sweep, lowest_k, mae_by_k, predict_all_neighbors, predict_knn, predict_knn_for,
    predict_table,
)
from kindred.plans.report import overlap_stats, storage
from kindred.schema import FitSettings
from brute import Brute

SCHEMA = "user_id bigint, item_id bigint, rating double"

# From no hot item at all, through a mixture, to everything in small tiles.
SETTINGS = {
    "joined": FitSettings(),
    "long lists": FitSettings(tiled_user_ratings=15),
    "mixed": FitSettings(hot_item_ratings=12, tiled_user_ratings=15, tile_users=8),
    "tiled": FitSettings(hot_item_ratings=1, tile_users=64, tile_ratings=40),
}


def skewed_rows():
    """60 users; item 0 has a third of all ratings, user 0 rates nearly everything."""
    rng = random.Random(7)
    rows = {}
    for u in range(60):
        if u % 6 or u == 0:
            rows[u, 0] = float(rng.randint(1, 5))
        for i in rng.sample(range(1, 80), 3):
            rows[u, i] = float(rng.randint(1, 5))
    for i in range(1, 70):
        rows[0, i] = float(rng.randint(1, 5))
    for i in range(30, 35):  # a user who always says the same
        rows[77, i] = 4.0
    test = [(u, i, float(rng.randint(1, 5))) for u in range(0, 60) for i in (0, 5, 17, 33, 200)]
    test = [t for t in test if (t[0], t[1]) not in rows]
    return [(u, i, r) for (u, i), r in rows.items()], test


@pytest.fixture(scope="module")
def data(spark):
    train, test = skewed_rows()
    return spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), Brute(train), test


@pytest.fixture(scope="module", params=list(SETTINGS))
def fitted(request, data):
    return fit(data[0], SETTINGS[request.param])


@pytest.mark.parametrize("metric", ["cosine", "jaccard", "overlap"])
def test_pairs(fitted, data, metric):
    rows = pairs.similarity_pairs(fitted, metric).collect()
    found = {(r.user_id, r.neighbor_id): r.similarity for r in rows}
    assert len(found) == len(rows)
    assert found == pytest.approx(data[2].pairs(metric), abs=2e-9)


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
@pytest.mark.parametrize("k", [1, 4, None])
def test_top_k(fitted, data, metric, k):
    found = {}
    for r in top_k(fitted, k, metric).collect():
        found[r.user_id, r.rank] = (r.neighbor_id, r.similarity)
    expected = {
        (u, n + 1): e for u, x in data[2].ranked(metric).items() for n, e in enumerate(x[:k])
    }
    assert found == expected


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
@pytest.mark.parametrize("fallback", ["user_mean", "drop"])
def test_all_neighbor_predictions(fitted, data, metric, fallback):
    _, test, brute, wanted = data
    found = {
        (r.user_id, r.item_id): r.prediction
        for r in predict_all_neighbors(fitted, test, metric, fallback).collect()
    }
    expected = brute.predict(wanted, brute.ranked(metric), None, fallback == "user_mean")
    assert found == pytest.approx(expected, abs=1e-7)


@pytest.mark.parametrize("k", [1, 3, 10, 500])
def test_knn_predictions(fitted, data, k):
    _, test, brute, wanted = data
    found = {(r.user_id, r.item_id): r.prediction for r in predict_knn(fitted, test, k).collect()}
    assert found == pytest.approx(brute.predict(wanted, brute.ranked(), k), abs=1e-7)


def test_knn_predictions_for_few_users(fitted, data):
    _, test, brute, wanted = data
    found = {
        (r.user_id, r.item_id): r.prediction
        for r in predict_knn_for(fitted, test.where("user_id in (0, 3, 6)"), 4).collect()
    }
    few = [t for t in wanted if t[0] in (0, 3, 6)]
    assert found == pytest.approx(brute.predict(few, brute.ranked(), 4), abs=1e-7)


def test_full_table(fitted, data):
    brute = data[2]
    found = {(r.user_id, r.item_id): r.prediction for r in predict_table(fitted, 5).collect()}
    items = {i for x in brute.by_user.values() for i in x}
    cells = [(u, i) for u in brute.by_user for i in items]
    expected = brute.predict(cells, brute.ranked(), 5, fallback=False)
    assert found == pytest.approx({c: p for c, p in expected.items() if p is not None}, abs=1e-7)


@pytest.mark.parametrize("fallback", ["user_mean", "drop"])
def test_mae_curve_sweep_and_lowest_k(spark, monkeypatch, fitted, data, fallback):
    monkeypatch.setattr(knn, "K_RANGE", 7)
    _, test, brute, wanted = data
    ranked, truth = brute.ranked(), {(u, i): r for u, i, r in wanted}

    def error(k):
        p = brute.predict(wanted, ranked, k, fallback == "user_mean")
        errors = [abs(truth[c] - x) for c, x in p.items() if x is not None]
        return len(errors), (sum(errors) / len(errors) if errors else None)

    points = {r.k: (r.n, r.mae) for r in mae_by_k(fitted, test, fallback=fallback).collect()}
    for k in range(1, 62):
        at = max((x for x in points if x <= k), default=None)
        n, expected = error(k)
        if at is None:
            assert n == 0
        else:
            assert points[at][0] == n
            assert points[at][1] == pytest.approx(expected, abs=1e-7)
    swept = {r.k: (r.n, r.mae) for r in knn_sweep(fitted, test, (2, 9, 40), fallback=fallback).collect()}
    for k, (n, value) in swept.items():
        assert (n, value) == (error(k)[0], pytest.approx(error(k)[1], abs=1e-7))

    values = {k: error(k)[1] for k in range(1, 62)}
    goal = sorted(v for v in values.values() if v is not None)[20] + 1e-6
    curve = mae_by_k(fitted, test, fallback=fallback)
    hit = lowest_k(curve, spark.createDataFrame([(goal,)], "mae double")).first()
    assert hit.k == min(k for k, v in values.items() if v is not None and v < goal)
    none = lowest_k(curve, spark.createDataFrame([(0.0,)], "mae double")).first()
    assert none.k is None and none.target_mae == 0.0


def test_statistics(fitted, data):
    brute = data[2]
    users = len(brute.by_user)
    overlaps = list(brute.pairs("overlap").values())
    total = users * (users - 1) // 2
    overlaps += [0.0] * (total - len(overlaps))
    mean = sum(overlaps) / total
    row = overlap_stats(fitted).first()
    assert (row.users, row.pairs, row.min, row.max) == (users, total, min(overlaps), max(overlaps))
    assert row.average == pytest.approx(mean)
    assert row.stddev == pytest.approx((sum((o - mean) ** 2 for o in overlaps) / total) ** 0.5)
    nonzero = sum(s != 0 for s in brute.pairs("cosine").values())
    row = storage(fitted).first()
    assert (row.nonzero_pairs, row.nonzero_bytes, row.bytes) == (nonzero, 8 * nonzero, 8 * total)


def test_mixture_really_uses_both_ways(data):
    flags = fit(data[0], SETTINGS["mixed"]).vectors.agg(
        F.count_if("tiled").alias("tiled"), F.count_if(~F.col("tiled")).alias("joined"),
        F.count_if("hot").alias("hot"), F.count_if(F.col("hot") & ~F.col("tiled")).alias("hot_user"),
    ).first()
    assert min(flags) > 0


def test_hot_item_is_not_joined_with_itself(data):
    """No more than the few long-list users may stand on the right of a hot item."""
    fitted = fit(data[0], SETTINGS["mixed"])
    right = fitted.vectors.where("hot and not tiled").groupBy("item_id").count()
    assert right.agg(F.max("count")).first()[0] <= 2


def test_only_ratings_of_hot_items_are_replicated(data):
    """Rows into tiles: hot ratings of tiled users x blocks; light items send one row per pair that shares one."""
    settings = SETTINGS["mixed"]
    rows = pairs.usable(fit(data[0], settings).vectors, pairs.COSINE)
    tiled = rows.where("tiled")
    users, hot = tiled.select("user_id").distinct().count(), tiled.where("hot").count()
    assert 0 < hot < tiled.count()
    blocks = tiles.heavy_rows(rows, settings).agg(F.max("blocks")).first()[0]
    assert abs(blocks - users / settings.tile_users) <= 2 < blocks  # users are counted approximately
    assert tiles.tiled_rows(rows, settings).count() == hot * blocks
    sums = tiles.light_rows(rows, settings)
    assert sums.count() == sums.select("first", "second").distinct().count() > 0

"""Saved models, folded-in users, and the split chosen from the ratings."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import pairs
from kindred.operators.neighbors import top_k
from kindred.operators.store import fold_in, load, save, unload
from kindred.operators.vectors import fit, split_at
from kindred.plans.knn import predict_knn, predict_table
from kindred.schema import FitSettings, RatingScale
from brute import Brute

SCHEMA = "user_id bigint, item_id bigint, rating double"
SETTINGS = {
    "joined": FitSettings(), "long lists": FitSettings(tiled_user_ratings=6),
    "mixed": FitSettings(hot_item_ratings=8, tiled_user_ratings=9, tile_users=8),
}


def ratings(seed, users, items=25):
    rng = random.Random(seed)
    return [(u, i, float(rng.randint(1, 5))) for u in users for i in rng.sample(range(items), rng.randrange(3, 12))]


def neighbors(fitted, k=4):
    return {(r.user_id, r.rank): (r.neighbor_id, r.similarity) for r in top_k(fitted, k).collect()}


def expected(rows, k=4):
    return {(u, n + 1): e for u, x in Brute(rows).ranked().items() for n, e in enumerate(x[:k])}


@pytest.fixture(scope="module")
def base():
    return ratings(1, range(40))


@pytest.mark.parametrize("name", list(SETTINGS))
def test_saved_model_gives_the_same(spark, tmp_path, base, name):
    fitted = fit(spark.createDataFrame(base, SCHEMA), SETTINGS[name], RatingScale(1.0, 5.0))
    save(fitted, str(tmp_path / "model"), 3)
    again = load(spark, str(tmp_path / "model"))
    assert (again.settings, again.bounds, again.long_groups) == (fitted.settings, fitted.bounds, fitted.long_groups)
    assert (again.hot_items is None) == (fitted.hot_items is None) and (again.by_user is None) == (name != "joined")
    assert sorted(again.vectors.collect()) == sorted(fitted.vectors.collect())
    assert neighbors(again) == neighbors(fitted) == expected(base)
    cells = spark.createDataFrame([(u, i, 3.0) for u in range(0, 40, 3) for i in range(25)], SCHEMA)
    both = [sorted((r.user_id, r.item_id, round(r.prediction, 8)) for r in predict_knn(m, cells, 5).collect()) for m in (fitted, again)]
    tables = [sorted((r.user_id, r.item_id, round(r.prediction, 8)) for r in predict_table(m, 5).collect()) for m in (fitted, again)]
    assert both[0] == both[1] and both[0] and tables[0] == tables[1] and tables[0]
    unload(again)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kindred_")]


def below_joins(plan):
    """The nodes between each scan of a model's rows and the first join or aggregate above it."""
    lines = [line.lstrip(" :+-*(0123456789)") for line in plan.splitlines()]
    out = []
    for at, line in enumerate(lines):
        if "Scan parquet" in line and "kindred_light" in line:
            above = []
            for up in reversed(lines[:at]):
                if "Join" in up or "Aggregate" in up:
                    break
                above.append(up)
            out.append(above)
    return out


def test_predictions_from_a_saved_model_do_not_shuffle_it(spark, tmp_path, base):
    save(fit(spark.createDataFrame(base, SCHEMA)), str(tmp_path / "model"), 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = load(spark, str(tmp_path / "model"))
        plan = pairs.joined_pairs(model, pairs.COSINE)._jdf.queryExecution().executedPlan().toString()
        scans = below_joins(plan)
        assert len(scans) == 2 and not [n for nodes in scans for n in nodes if "Exchange" in n]
        plain = pairs.joined_pairs(fit(spark.createDataFrame(base, SCHEMA)), pairs.COSINE)
        assert "Exchange hashpartitioning(item_id" in plain._jdf.queryExecution().executedPlan().toString()
        unload(model)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", list(SETTINGS))
def test_folding_in_equals_fitting_again(spark, base, name):
    """New users, changed users, users that left, one of them unknown, and rows with nulls or repeats."""
    changed = ratings(2, [3, 7, 50, 51])
    rows = spark.createDataFrame([*changed, (3, None, 1.0), (None, 3, 1.0), (52, 1, None)], SCHEMA)
    rows = rows.unionByName(rows.where("user_id = 51"))
    left = spark.createDataFrame([(5,), (6,), (999,), (None,)], "user_id bigint")
    after = [r for r in base if r[0] not in (3, 7, 5, 6)] + changed
    fitted = fold_in(fit(spark.createDataFrame(base, SCHEMA), SETTINGS[name]), rows, left)
    again = fit(spark.createDataFrame(after, SCHEMA), SETTINGS[name])
    keep = ["user_id", "item_id", "n_rated"]
    numbers = lambda m: sorted((*(r[c] for c in keep), round(r.dev, 9), None if r.pdev is None else round(r.pdev, 9)) for r in m.vectors.collect())
    assert numbers(fitted) == numbers(again)
    assert neighbors(fitted) == neighbors(again) == expected(after)
    nothing = fold_in(fitted, rows.limit(0))
    assert numbers(nothing) == numbers(again)


def test_folding_in_reads_only_changed_ratings(spark, base):
    """Only the changed users' ratings are staged; the model's rows are filtered where they are."""
    fitted = fit(spark.createDataFrame(base, SCHEMA))
    plan = fold_in(fitted, spark.createDataFrame(ratings(2, [3]), SCHEMA)).vectors._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 3 and "LeftAnti" in plan and "Window" not in plan


def test_the_split_follows_the_histogram(spark):
    def degrees(*pairs):
        rows = [(u, i, 1.0) for i, d in enumerate(pairs) for u in range(d)]
        frame = spark.createDataFrame(rows, SCHEMA)
        return frame.groupBy("item_id").agg(F.count("*").alias("n")), frame

    settings = FitSettings(hot_item_ratings=None, tile_users=10)
    even, rows = degrees(*[6] * 50)
    assert split_at(even, rows, settings) == 6
    # 5 items of 150 raters: 55,875 pair rows joined, 750 ratings x 15 blocks in tiles.
    skewed, rows = degrees(*[6] * 50, *[150] * 5)
    assert split_at(skewed, rows, settings) == 6
    none, rows = degrees()
    assert split_at(none, rows, settings) == settings.tile_users


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_the_chosen_split_changes_no_result(spark, metric):
    rows = ratings(4, range(60), 15)
    fitted = fit(spark.createDataFrame(rows, SCHEMA), FitSettings(hot_item_ratings=None, tile_users=16))
    found = {(r.user_id, r.neighbor_id): r.similarity for r in pairs.similarity_pairs(fitted, metric).collect()}
    assert isinstance(fitted.settings.hot_item_ratings, int) and found == pytest.approx(Brute(rows).pairs(metric), abs=2e-9)

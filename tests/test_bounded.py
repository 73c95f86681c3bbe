"""Skipped tiles: the same neighbours, fewer tiles."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import bounded, pairs
from kindred.operators.neighbors import top_k
from kindred.operators.vectors import fit
from kindred.schema import FitSettings
from kindred.sources.staging import stage
from brute import Brute

SCHEMA = "user_id bigint, item_id bigint, rating double"


def cliques(seed=5, groups=30, size=6):
    """Groups of users with the same taste in items of their own; everybody also rates two hot items, most with little weight."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        taste = {1000 + 20 * g + i: rng.choice([1.0, 2.0, 4.0, 5.0]) for i in range(12)}
        for n in range(size):
            u = g * size + n
            mine = {i: r for i, r in taste.items() if rng.random() < 0.9}
            rows += [(u, i, r) for i, r in mine.items()]
            mean = sum(mine.values()) / len(mine)
            loud = g % 10 == 0
            rows += [(u, hot, float(rng.choice([1, 5])) if loud else round(mean) + 0.0) for hot in (1, 2)]
    return rows


@pytest.mark.parametrize("k", [1, 3, 5, 40])
def test_equals_all_tiles_and_brute_force(spark, k):
    rows = cliques()
    train = spark.createDataFrame(rows, SCHEMA)
    found = []
    for skip in (True, False, None):
        fitted = fit(train, FitSettings(hot_item_ratings=20, tile_users=12, skip_tiles=skip))
        found.append({(r.user_id, r.rank): (r.neighbor_id, r.similarity) for r in top_k(fitted, k).collect()})
    expected = {(u, n + 1): e for u, x in Brute(rows).ranked().items() for n, e in enumerate(x[:k])}
    assert found[0] == found[1] == found[2] == expected


def test_tiles_are_skipped_and_floors_hold(spark):
    rows = cliques()
    settings = FitSettings(hot_item_ratings=20, tile_users=12)
    fitted = fit(spark.createDataFrame(rows, SCHEMA), settings)
    usable = pairs.usable(fitted.vectors, pairs.COSINE)
    places = stage(bounded.placed_users(usable, settings), "places")
    sizes = places.groupBy("block").count().agg(F.count("*"), F.sum("count")).first()
    assert sizes[1] == 180 and sizes[0] > 10
    light = stage(bounded._light(usable, places).where("a_block <> b_block"), "light")
    k = 3
    inside = [(u, v, s) for u, x in Brute(rows).ranked().items() for v, s in x]
    block = {r.user_id: r.block for r in places.collect()}
    first = spark.createDataFrame([e for e in inside if block[e[0]] == block[e[1]]], "user_id bigint, neighbor_id bigint, similarity double")
    users = stage(bounded.floors(first, light, places, k), "floors")
    best = {u: x for u, x in Brute(rows).ranked().items()}
    for r in users.collect():
        assert r.floor <= best[r.user_id][k - 1][1]
    tiles_opened = bounded.opened(bounded.visits(users, light)).count()
    everything = sizes[0] * (sizes[0] - 1) // 2
    assert 0 < tiles_opened < 0.8 * everything

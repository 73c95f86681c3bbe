"""Recommendations against brute force."""

import random

import pytest

from kindred.operators.neighbors import neighbor_lists, top_k
from kindred.operators.vectors import fit
from kindred.plans.recommend import (
    recommend_baseline, recommend_knn, recommend_knn_all, recommend_popular,
)
from kindred.schema import FitSettings
from brute import Brute, denorm, half_up

SCHEMA = "user_id bigint, item_id bigint, rating double"
ME = 900


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(u, i, float(rng.randint(1, 5))) for u in range(30) for i in rng.sample(range(40), 8)]
    mine = [(ME, i, float(rng.randint(1, 5))) for i in range(0, 40, 4)]
    return out, mine


@pytest.fixture(scope="module")
def frames(spark, rows):
    titles = spark.createDataFrame([(i, f"title {i}") for i in range(39)], "item_id bigint, title string")
    return spark.createDataFrame(rows[0], SCHEMA), spark.createDataFrame(rows[1], SCHEMA), titles


def best(scores, n):
    ordered = sorted(scores.items(), key=lambda x: (-half_up(x[1]), x[0]))[:n]
    return [(rank + 1, item, pytest.approx(score, abs=1e-8)) for rank, (item, score) in enumerate(ordered)]


def found(df):
    return sorted((r["rank"], r.item_id, r.prediction) for r in df.collect())


def item_scores(rows, mine):
    brute = Brute(rows)
    mean = sum(r for _, _, r in mine) / len(mine)
    devs = {}
    for u, x in brute.dev.items():
        for i, d in x.items():
            devs.setdefault(i, []).append(d)
    return {i: denorm(mean, sum(x) / len(x)) for i, x in devs.items()}, {i: len(x) for i, x in devs.items()}


@pytest.mark.parametrize("exclude", [True, False])
def test_baseline_and_popularity(rows, frames, exclude):
    ratings, personal, titles = frames
    scores, counts = item_scores(*rows)
    rated = {i for _, i, _ in rows[1]} if exclude else set()
    scores = {i: s for i, s in scores.items() if i not in rated}
    got = recommend_baseline(ratings, personal, ME, 6, titles, exclude_rated=exclude)
    assert found(got) == best(scores, 6)
    most = max(counts.values())
    weighted = {i: s * counts[i] / most for i, s in scores.items()}
    got = recommend_popular(ratings, personal, ME, 6, titles, exclude_rated=exclude)
    assert found(got) == best(weighted, 6)
    assert all(r.user_id == ME for r in got.collect())


@pytest.mark.parametrize("k", [3, 30])
@pytest.mark.parametrize("settings", [FitSettings(), FitSettings(hot_item_ratings=4, tile_users=8)])
def test_knn_for_one_and_for_all(spark, rows, frames, k, settings):
    ratings, personal, titles = frames
    everyone = rows[0] + rows[1]
    brute = Brute(everyone)
    ranked = brute.ranked()
    items = {i for _, i, _ in everyone}

    def expected(u):
        cells = [(u, i) for i in items if i not in brute.by_user[u]]
        return best({
            i: p for (_, i), p in brute.predict(cells, ranked, k, fallback=False).items() if p is not None
        }, 5)

    fitted = fit(ratings.unionByName(personal), settings)
    target = spark.createDataFrame([(ME,)], "user_id bigint")
    mine = recommend_knn(fitted, target, k, 5, titles)
    assert found(mine) == expected(ME)
    assert {r.item_id: r.title for r in mine.collect()} == {
        i: (f"title {i}" if i < 39 else None) for _, i, _ in found(mine)
    }
    everybody = recommend_knn_all(fitted, k).collect()
    for u in brute.by_user:
        got = sorted((r["rank"], r.item_id, r.prediction) for r in everybody if r.user_id == u)
        assert got == expected(u)


def test_ties_go_to_the_smaller_item(spark):
    """Two users, one opinion: every item of the better group is predicted alike."""
    rows = [(1, i, 5.0 if i % 2 else 1.0) for i in (9, 7, 5, 3, 8, 6)]
    ratings = spark.createDataFrame(rows, SCHEMA)
    me = spark.createDataFrame([(2, 100, 3.0)], SCHEMA)
    got = recommend_baseline(ratings, me, 2, 3)
    assert [i for _, i, _ in found(got)] == [3, 5, 7]


def test_neighbor_lists(frames, rows):
    lists = neighbor_lists(top_k(fit(frames[0]), 4)).collect()
    expected = Brute(rows[0]).ranked()
    assert {r.user_id: [n.neighbor_id for n in r.neighbors] for r in lists} == {
        u: [v for v, _ in x[:4]] for u, x in expected.items()
    }

"""Lists of co-raters must give what the pair join gives, whatever the number of parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import lists, pairs
from kindred.operators.neighbors import top_k
from kindred.operators.vectors import fit
from kindred.plans.knn import edges_by_k, knn_sweep, mae_by_k, predict_all_neighbors, predict_knn, predict_table
from kindred.plans.recommend import recommend_knn_all
from kindred.plans.report import overlap_stats, storage
from kindred.schema import FitSettings
from test_skew import SCHEMA, skewed_rows

#: How far apart the ids of users are: neighbouring, and too far for one number per pair.
SPREAD = {"near": 1, "far": 1 << 55}


def rounded_rows(df):
    return sorted(tuple(round(x, 7) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.fixture(scope="module", params=list(SPREAD))
def data(request, spark):
    by = SPREAD[request.param]
    train, test = ([(u * by - 3, i, r) for u, i, r in rows] for rows in skewed_rows())
    # A rating beyond the scale has no deviation where the mean has no room, a cell may be asked for twice.
    train += [(500, 1, 1.0), (500, 2, 1.0), (500, 3, 1.0)]
    return spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test + test[:3], SCHEMA)


QUERIES = {
    **{f"pairs {m}": lambda f, t, m=m: pairs.similarity_pairs(f, m) for m in ("cosine", "jaccard", "overlap")},
    **{f"top {k} {m}": lambda f, t, m=m, k=k: top_k(f, k, m).select("user_id", "neighbor_id", "similarity", "rank")
       for m in ("cosine", "jaccard") for k in (3, None)},
    **{f"all {m} {b}": lambda f, t, m=m, b=b: predict_all_neighbors(f, t, m, b) for m in ("cosine", "jaccard") for b in ("drop", "user_mean")},
    "knn": lambda f, t: predict_knn(f, t, 4, fallback="drop"),
    "sweep": lambda f, t: knn_sweep(f, t, (1, 5, 30)),
    "curve": lambda f, t: mae_by_k(f, t),
    "curve drop": lambda f, t: mae_by_k(f, t, fallback="drop"),
    "overlaps": lambda f, t: overlap_stats(f),
    "storage": lambda f, t: storage(f),
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_lists_equal_the_join(monkeypatch, data, name):
    fitted = fit(data[0])
    joined = rounded_rows(QUERIES[name](fitted, data[1]))
    monkeypatch.setattr(lists, "PART_PAIRS", 900)
    assert lists.part_count(fitted) > 3
    assert rounded_rows(QUERIES[name](fitted, data[1])) == joined and joined


ROUNDS = {
    **{name: QUERIES[name] for name in ("pairs cosine", "pairs overlap", "top 3 cosine", "knn", "curve drop", "overlaps")},
    "table": lambda f, t: predict_table(f, 3),
    "recommended": lambda f, t: recommend_knn_all(f, 3, 2),
    "edges": lambda f, t: edges_by_k(f, (2, 30)),
}


@pytest.mark.parametrize("data", ["near"], indirect=True)
@pytest.mark.parametrize("name", list(ROUNDS))
def test_rounds_equal_the_join_and_keep_no_lists(monkeypatch, data, name):
    """All lists were shuffled at once, and with what joins with them stayed on disk together."""
    fitted = fit(data[0])
    joined = rounded_rows(ROUNDS[name](fitted, data[1]))
    monkeypatch.setattr(lists, "PART_PAIRS", 900)
    monkeypatch.setattr(lists, "ROUND_PARTS", 1)
    monkeypatch.setattr(lists, "ROUNDS", 3)
    assert lists.round_count(lists.part_count(fitted)) == 3
    found = ROUNDS[name](fitted, data[1])
    assert found._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 0  # no lists in the plan left to run
    assert rounded_rows(found) == joined and joined


def test_packed_pairs_come_back():
    users, neighbors = np.array([-5, -5, 1 << 60]), np.array([-2, 1 << 61, 3])
    for similarity in ([0.1, -0.123456789, 1.0], [0.5, np.nan, 0.0], [1e10, 3.0, 0.25], [1 / 3, 0.0, 1.0]):
        packed = [users, neighbors, np.array(similarity)]
        assert [x.tobytes() for x in lists.unpacked_pairs(*lists.packed_pairs(*packed))] == [x.tobytes() for x in packed]


def test_a_round_has_enough_parts_and_there_are_few():
    assert [lists.round_count(p) for p in (1, 23, 48, 191, 192, 5_000)] == [1, 1, 2, 7, 8, 8]


@pytest.mark.parametrize("name", ["sweep", "curve", "all cosine drop", "all jaccard user_mean"])
def test_stored_rows_without_a_rating(monkeypatch, data, name):
    """A neighbour whose rating of the cell's item is null still has its weight in the denominator, as in the join."""
    item, user = F.col("item_id"), F.col("user_id")
    fitted = fit(data[0].withColumn("rating", F.when((item + user) % 4 != 0, F.col("rating"))), stored=True)
    joined = rounded_rows(QUERIES[name](fitted, data[1]))
    monkeypatch.setattr(lists, "PART_PAIRS", 900)
    assert lists.part_count(fitted) and rounded_rows(QUERIES[name](fitted, data[1])) == joined


def test_lists_shuffle_pairs_once(monkeypatch, data):
    """One shuffle of lists by user, and none of pairs: predictions add only the joins with their own cells."""
    fitted = fit(data[0])
    monkeypatch.setattr(lists, "PART_PAIRS", 900)
    plan = pairs.similarity_pairs(fitted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Join" not in plan  # by item, by user


def test_tasks_that_make_lists_follow_the_products(monkeypatch, data):
    """Their number came from the size of the ratings: few tasks made all lists, and spilled."""
    monkeypatch.setattr(lists, "PART_PAIRS", 300)
    plan = pairs.similarity_pairs(fit(data[0]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "REPARTITION_BY_COL" not in plan


def test_packed_arrays_come_back():
    for values in (np.array([], np.int32), np.array([3, -1, 1 << 62]), np.array([0.1, np.nan, -0.0])):
        back = lists.expand(lists.squeeze(values), values.dtype.type)
        assert back.dtype == values.dtype and back.tobytes() == values.tobytes()


def test_long_lists_of_a_user_are_left_to_the_join(monkeypatch, data):
    monkeypatch.setattr(lists, "PART_PAIRS", 900)
    monkeypatch.setattr(lists, "USER_PAIRS", 100)
    assert lists.part_count(fit(data[0])) is None


def test_an_item_with_fewer_raters_than_blocks_is_not_hot(spark):
    """400 items of 6 raters each among 600 users: tiles would get each rating 75 times, the join 5 times."""
    rows = [(i * 6 % 600 + n, i, float(1 + (i + n) % 5)) for i in range(400) for n in range(6)]
    rows += [(u, 1000, float(1 + u % 5)) for u in range(300)]
    settings = FitSettings(hot_item_ratings=4, tile_users=8)
    fitted = fit(spark.createDataFrame(rows, SCHEMA), settings)
    assert [r.item_id for r in fitted.hot_items.collect()] == [1000]
    assert fitted.vectors.where("hot").agg(F.count("*")).first()[0] == 300


@pytest.mark.parametrize("top", [5_000, 1 << 40, 1 << 62])
def test_sorted_positions_are_those_of_a_stable_sort(top):
    keys = np.random.default_rng(1).integers(0, 50, 3_000) * (top // 50)
    found, order = lists.in_order(keys, top)
    assert (order == np.argsort(keys, kind="stable")).all() and (found == np.sort(keys)).all()
    assert [len(x) for x in lists.in_order(keys[:0], 1)] == [0, 0]


def ranked(users, similarity):
    part = lists.Part.__new__(lists.Part)
    part.users, part.similarity = users, similarity
    return part.best_first()


@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e6])
def test_ranks_in_groups_of_users(monkeypatch, scale):
    rnd = np.random.default_rng(2)
    users = np.sort(rnd.integers(-3, 60, 4_000))
    similarity = np.floor(rnd.integers(-40, 40, 4_000) / 40 * scale * 1e9 + 0.5) / 1e9
    monkeypatch.setattr(lists, "SORTED_PAIRS", 100)
    order, rank = ranked(users, similarity)
    assert (order == np.lexsort((-similarity, users))).all()
    assert rank.tolist() == [i + 1 for n in np.unique(users, return_counts=True)[1] for i in range(n)]
    assert [len(x) for x in ranked(users[:0], similarity[:0])] == [0, 0]


def test_repeated_doubles_travel_as_a_list_of_different_ones():
    rnd = np.random.default_rng(3)
    some = np.concatenate((rnd.standard_normal(900), [np.nan, -0.0, 0.0, np.inf]))
    for values in (some, some[rnd.integers(0, 904, 9_000)], some[:0], some[:1], np.full(700, np.nan)):
        assert lists.expand(lists.squeeze(values), np.float64).tobytes() == values.tobytes()
    few = some[rnd.integers(0, 904, 9_000)]
    assert len(lists.squeeze(few)) < 0.4 * few.nbytes  # 0.8 before


def test_large_jobs_send_large_rows():
    assert [lists.senders(p) for p in (1, 4, 40, 240, 1_450, 16_000)] == [1, 2, 20, 96, 96, 1_000]

"""Properties over generated ratings."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kindred.operators import pairs
from kindred.operators.vectors import fit
from kindred.plans.knn import predict_all_neighbors, predict_knn
from kindred.schema import FitSettings
from brute import Brute

SCHEMA = "user_id bigint, item_id bigint, rating double"

ratings = st.dictionaries(
    st.tuples(st.integers(1, 8), st.integers(1, 8)), st.sampled_from([1.0, 2.0, 2.5, 3.0, 4.0, 5.0]),
    min_size=4, max_size=40,
)
how = st.sampled_from([FitSettings(), FitSettings(hot_item_ratings=2, tiled_user_ratings=6, tile_users=3)])
few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)


@few
@given(ratings, how)
def test_similarity_bounds_and_values(spark, data, how):
    train = [(u, i, r) for (u, i), r in data.items()]
    fitted = fit(spark.createDataFrame(train, SCHEMA), how)
    for metric in (pairs.COSINE, pairs.JACCARD):
        found = {(r.user_id, r.neighbor_id): r.similarity for r in pairs.similarity_pairs(fitted, metric).collect()}
        assert found == pytest.approx(Brute(train).pairs(metric), abs=2e-9)
        low = -1 if metric == pairs.COSINE else 0
        assert all(low - 1e-9 <= s <= 1 + 1e-9 for s in found.values())


@few
@given(ratings, how)
def test_predictions_stay_on_the_scale_and_large_k_is_everyone(spark, data, how):
    train = [(u, i, r) for (u, i), r in data.items()]
    fitted = fit(spark.createDataFrame(train, SCHEMA), how)
    cells = [(u, i, 3.0) for u in range(1, 9) for i in range(1, 9) if (u, i) not in data]
    if not cells:
        return
    test = spark.createDataFrame(cells, SCHEMA)
    everyone = {(r.user_id, r.item_id): r.prediction for r in predict_all_neighbors(fitted, test).collect()}
    nearest = {(r.user_id, r.item_id): r.prediction for r in predict_knn(fitted, test, 50).collect()}
    assert nearest == pytest.approx(everyone, abs=1e-9)
    assert all(1 - 1e-9 <= p <= 5 + 1e-9 for p in everyone.values())

"""One answer for repeated and NULL ratings whatever the settings, and values at the edges."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kindred.functions import rounded
from kindred.operators import pairs
from kindred.operators.neighbors import top_k
from kindred.operators.stats import user_means
from kindred.operators.vectors import fit, one_rating_each
from kindred.plans.knn import lowest_k
from kindred.schema import FitSettings
from kindred.sources import read_ratings
from tests.conftest import RATINGS

SETTINGS = [
    FitSettings(),
    FitSettings(hot_item_ratings=3, tile_users=4),
    FitSettings(hot_item_ratings=3, tiled_user_ratings=4, tile_users=4),
    FitSettings(tiled_user_ratings=1),
]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(14) for i in range(9) if (u + i) % 3 or i == 0]
    repeats = [(u, i, 5.0) for u, i, _ in rows[::4]] + rows[::5]
    nulls = [(3, 50, None), (None, 1, 2.0), (4, None, 2.0), (3, 0, None)]
    return spark.createDataFrame(rows + repeats + nulls, RATINGS)


def found(fitted):
    out = [sorted(map(tuple, pairs.similarity_pairs(fitted, m).collect())) for m in (pairs.COSINE, pairs.JACCARD, pairs.OVERLAP)]
    return [*out, sorted(map(tuple, top_k(fitted, 3).collect()))]


def test_repeated_and_null_rows_count_once_under_all_settings(spark, messy):
    clean = one_rating_each(messy)
    assert clean.count() == messy.dropna().select("user_id", "item_id").distinct().count()
    expected = found(fit(clean))
    for settings in SETTINGS:
        assert found(fit(messy, settings)) == expected
    assert all(0 < s <= 1 for _, _, s in expected[1])


def test_a_user_has_one_mean(spark):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, 3.0), (1, 3, 5.0)], "user_id bigint, item_id bigint, rating double")
    assert [(r.user_mean, r.n) for r in user_means(rows).collect()] == [(4.0, 2)]
    assert [(r.user_mean, r.n_rated) for r in fit(rows).users.collect()] == [(4.0, 2)]


@pytest.mark.parametrize("line", ["5::6", "5::6::", "5", "5::6::x"])
def test_a_short_or_malformed_line_fails(spark, tmp_path, line):
    (tmp_path / "r").write_text(f"1::2::3\n{line}\n")
    with pytest.raises(PySparkException):
        read_ratings(spark, str(tmp_path / "r"), sep="::").collect()


def test_rounding_does_not_saturate(spark):
    values = [12345678.5, 1e300, -1e18, 0.1234567890123, -0.5]
    out = spark.createDataFrame([(v,) for v in values], "v double").select(rounded(F.col("v"), 12).alias("r")).collect()
    assert [r.r for r in out][:3] == values[:3] and out[3].r == 0.123456789012 and out[4].r == -0.5


def test_the_target_is_known_without_a_curve(spark):
    curve = spark.createDataFrame([], "k bigint, n bigint, mae double")
    target = spark.createDataFrame([("baseline", 0.75)], "model string, mae double")
    assert [tuple(r) for r in lowest_k(curve, target).collect()] == [(0.75, None, None)]

"""One registered query per operator, over ratings derived from the sales tables.

Every query reads whole tables.  ``train_test`` is the evaluation's hold-out split:
models are fitted on train and judged on test.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import rounded
from kindred.operators import pairs
from kindred.operators.bitmaps import item_bitmaps, set_overlaps, set_sizes, united
from kindred.operators.deviations import (
    deviations, item_deviations, processed_deviations, user_profiles,
)
from kindred.operators.joins import join_per_key
from kindred.operators.metrics import absolute_errors, compare, mae
from kindred.operators.neighbors import neighbor_lists, top_k
from kindred.operators.store import fold_in, load, save
from kindred.operators.stats import item_means, item_sets, mean_spread, global_mean, rating_stats, user_means
from kindred.operators.vectors import Fitted, fit
from kindred.schema import FitSettings
from kindred.plans.baseline import (
    predict_baseline, predict_global, predict_item_mean, predict_user_mean,
)
from kindred.plans.knn import (
    edges_by_k, knn_sweep, lowest_k, mae_by_k, predict_all_neighbors, predict_knn, predict_knn_for,
    predict_table,
)
from kindred.plans.recommend import (
    recommend_baseline, recommend_knn_all, recommend_knn_for_ks, recommend_popular,
)
from kindred.plans.report import model_comparison, overlap_stats, storage
from kindred.sources import (
    item_titles, personal_from_parts, personal_ratings, ratings_from_sales, read_personal,
    read_ratings, train_test, write_json,
)
from kindred.sources.checks import expect_count
from kindred.sources.staging import scratch, stage

PERSONAL_USER = -1
NEIGHBORS = 10
EVALUATED_K = 100


def neat(df: DataFrame, **places: int) -> DataFrame:
    """Round the named result columns, as the oracle does: to 12 places first, so that
    a value exactly halfway at 6 places is not decided by the last bit of a sum."""
    return df.select(*[
        rounded(rounded(F.col(c), 12), places[c]).alias(c) if c in places else F.col(c) for c in df.columns
    ])


def _ratings(spark: SparkSession, d: str) -> DataFrame:
    """The ratings, staged: most queries read them several times, and the join of the
    two fact tables under them should run once."""
    return stage(ratings_from_sales(spark, d), "ratings")


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return train_test(_ratings(spark, d))


def _seen(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows whose item occurs in train."""
    return test.join(train.select("item_id").distinct(), "item_id", "left_semi")


def _personal(spark: SparkSession, d: str) -> DataFrame:
    return personal_ratings(personal_from_parts(spark, d), PERSONAL_USER)


#: Settings under which items of the smallest tables are hot and users are compared in
#: several tiles, some users outside of them: the division of work at scale, on test data.
HOT = FitSettings(hot_item_ratings=25, tiled_user_ratings=45, tile_users=128, tile_ratings=4_000)


#: The split between joined and tiled items is chosen from the ratings; tiles small enough that it matters here.
CHOSEN = FitSettings(hot_item_ratings=None, tile_users=512)


def _fitted(spark: SparkSession, d: str, settings: FitSettings = FitSettings()) -> tuple[Fitted, DataFrame]:
    """Fitted on the training rows, with the held-out ones: for predictions and their errors."""
    train, test = _split(spark, d)
    return fit(train, settings, stored=True), test


def _fitted_all(spark: SparkSession, d: str, settings: FitSettings = FitSettings()) -> Fitted:
    return fit(_ratings(spark, d), settings, stored=True)


def _predictions(df: DataFrame) -> DataFrame:
    return neat(df.select("user_id", "item_id", "rating", "prediction"), rating=6, prediction=6)


def _metrics(df: DataFrame) -> DataFrame:
    return neat(df.select("model", "n", "mae"), mae=6)


# --- sources and sinks -------------------------------------------------------


def ratings_from_text(spark, d):
    """Ratings written as text with a two-character separator and read back."""
    path = scratch(spark, "ratings-text")
    line = F.concat_ws(" :: ", "user_id", "item_id", "rating", F.lit("0"))
    ratings_from_sales(spark, d).select(line.alias("value")).write.text(path)
    return neat(read_ratings(spark, path, sep="::"), rating=6)


def ratings_from_tab_text(spark, d):
    """Ratings written with tabs and read back, with their number checked."""
    path = scratch(spark, "ratings-tab")
    ratings = _ratings(spark, d)
    ratings.select(F.concat_ws("\t", "user_id", "item_id", "rating").alias("value")).write.text(path)
    return neat(expect_count(read_ratings(spark, path), ratings.count(), "ratings"), rating=6)


def personal_from_csv(spark, d):
    """A personal list written as CSV (quoted titles, empty ratings) and read back."""
    path = scratch(spark, "personal-csv")
    titled = personal_from_parts(spark, d).withColumn("title", F.concat("title", F.lit(", the")))
    titled.write.csv(path, quoteAll=False, nullValue="")
    return read_personal(spark, path)


def metrics_json(spark, d):
    """A metrics frame written as JSON and read back."""
    path = scratch(spark, "metrics-json")
    train, test = _split(spark, d)
    write_json(mae(predict_user_mean(train, test), "user"), path)
    return neat(spark.read.schema("model string, n bigint, mae double").json(path), mae=6)


def ratings_with_personal(spark, d):
    together = ratings_from_sales(spark, d).unionByName(_personal(spark, d))
    return neat(user_means(together), user_mean=6)


def rated_with_titles(spark, d):
    """The rated rows of the personal list with their titles."""
    return _personal(spark, d).join(item_titles(spark, d), "item_id", "left")


# --- means and spread --------------------------------------------------------


def q_rating_stats(spark, d):
    return neat(
        rating_stats(_ratings(spark, d)),
        global_mean=6, min=6, max=6, midrange=6, average=6, ratio_close=6,
    )


def q_user_means(spark, d):
    return neat(user_means(ratings_from_sales(spark, d)), user_mean=6)


def q_user_mean_stats(spark, d):
    r = _ratings(spark, d)
    spread = mean_spread(user_means(r), "user_mean", global_mean(r))
    return neat(spread, min=6, max=6, midrange=6, average=6, ratio_close=6)


def q_item_mean_stats(spark, d):
    r = _ratings(spark, d)
    spread = mean_spread(item_means(r), "item_mean", global_mean(r))
    return neat(spread, min=6, max=6, midrange=6, average=6, ratio_close=6)


def q_close_to_global_ratio(spark, d):
    stats = rating_stats(_ratings(spark, d)).select("grouped_by", "groups", "ratio_close", "all_close")
    return neat(stats, ratio_close=6)


def q_item_popularity(spark, d):
    means = item_means(_ratings(spark, d))
    most = means.agg(F.max("n")).scalar()
    return neat(means.withColumn("share_of_max", F.col("n") / most), item_mean=6, share_of_max=6)


def q_user_item_sets(spark, d):
    return item_sets(_ratings(spark, d))


def _cohort_bitmaps(spark, d):
    """Item sets of cohorts: users of the same whole number of mean stars and parity of id, so that cohorts can be united."""
    ratings = _ratings(spark, d)
    cohorts = user_means(ratings).select(
        "user_id", F.concat_ws("/", F.floor("user_mean"), F.col("user_id") % 2).alias("cohort")
    )
    rows = join_per_key(ratings.select("user_id", "item_id"), cohorts, "user_id", "item_id")
    return stage(item_bitmaps(rows, "cohort"), "bitmaps")


def q_cohort_item_sets(spark, d):
    """Different items of each cohort, and of the cohorts with the same number of stars together."""
    sets = _cohort_bitmaps(spark, d)
    stars = sets.select(F.split("cohort", "/")[0].alias("cohort"), "bucket", "items")
    return set_sizes(sets, "cohort").unionByName(set_sizes(united(stars, "cohort"), "cohort"))


def q_cohort_overlap(spark, d):
    """What each cohort's items share with those of the cohorts named after it."""
    sets = _cohort_bitmaps(spark, d)
    names = sets.agg(F.collect_set("cohort").alias("names"))  # as many as there are stars, twice
    wanted = names.select("names", F.explode("names").alias("a")).select("a", F.explode("names").alias("b")).where("a < b")
    return neat(set_overlaps(sets, "cohort", wanted), jaccard=6)


# --- mean predictors ---------------------------------------------------------


def _mae_of(predictor: Callable, model: str):
    def query(spark, d):
        train, test = _split(spark, d)
        return _metrics(mae(predictor(train, test), model))

    return query


def q_baseline_prediction(spark, d):
    train, test = _split(spark, d)
    return _predictions(predict_baseline(train, test))


def q_absolute_errors(spark, d):
    train, test = _split(spark, d)
    errors = absolute_errors(predict_user_mean(train, test))
    return neat(errors.select("user_id", "item_id", "error"), error=6)


def q_mae_baseline_on_test_deviations(spark, d):
    """Item deviations taken from the test rows themselves, around training means."""
    train, test = _split(spark, d)
    seen = _seen(train, test)
    return _metrics(
        mae(predict_baseline(train, seen, cold_items="drop", deviations_from=seen), "baseline")
    )


# --- deviations --------------------------------------------------------------


def q_normalized_deviation(spark, d):
    ratings = _ratings(spark, d)
    devs = deviations(ratings, user_means(ratings))
    return neat(devs, rating=6, user_mean=6, dev=6)


def q_item_mean_deviation(spark, d):
    ratings = _ratings(spark, d)
    return neat(item_deviations(deviations(ratings, user_means(ratings))), item_dev=6)


def q_processed_deviation(spark, d):
    ratings = _ratings(spark, d)
    rows = processed_deviations(ratings, user_profiles(ratings))
    return neat(rows.select("user_id", "item_id", "dev", "pdev"), dev=6, pdev=6)


# --- similarity --------------------------------------------------------------


def _pairs_of(metric: str, settings: FitSettings = FitSettings()):
    def query(spark, d):
        return pairs.similarity_pairs(_fitted_all(spark, d, settings), metric)

    return query


def q_overlap_stats(spark, d):
    return neat(overlap_stats(_fitted_all(spark, d)), average=6, stddev=6)


def q_overlap_stats_hot(spark, d):
    return neat(overlap_stats(_fitted_all(spark, d, HOT)), average=6, stddev=6)


def q_pair_count_storage(spark, d):
    return storage(_fitted_all(spark, d))


# --- neighbours and predictions ----------------------------------------------


def q_top_k_neighbors(spark, d):
    return top_k(_fitted_all(spark, d), NEIGHBORS)


def q_top_k_neighbors_hot(spark, d):
    return top_k(_fitted_all(spark, d, HOT), NEIGHBORS)


def q_top_k_neighbors_skipping(spark, d):
    """Tiles are opened only where bounds allow a neighbour."""
    return top_k(_fitted_all(spark, d, replace(HOT, skip_tiles=True)), NEIGHBORS)


def q_neighbor_lists(spark, d):
    lists = neighbor_lists(top_k(_fitted_all(spark, d), NEIGHBORS))
    return lists.select(
        "user_id", F.array_join(F.col("neighbors.neighbor_id"), ",").alias("neighbors")
    )


def _all_neighbor_predictions(metric: str, settings: FitSettings = FitSettings()):
    def query(spark, d):
        fitted, test = _fitted(spark, d, settings)
        return _predictions(predict_all_neighbors(fitted, test, metric))

    return query


def _mae_all_neighbors(metric: str):
    def query(spark, d):
        fitted, test = _fitted(spark, d)
        return _metrics(mae(predict_all_neighbors(fitted, test, metric), metric))

    return query


def q_knn_prediction(spark, d):
    fitted, test = _fitted(spark, d)
    return _predictions(predict_knn(fitted, test, EVALUATED_K))


def q_knn_prediction_for_users(spark, d):
    """The held-out ratings of the users whose id is divisible by 50: only their neighbours are looked for."""
    fitted, test = _fitted(spark, d)
    return _predictions(predict_knn_for(fitted, test.where("user_id % 50 = 0"), EVALUATED_K))


def q_knn_prediction_saved(spark, d):
    """The model is written to a folder, read back by its path alone, and predicts."""
    fitted, test = _fitted(spark, d)
    path = scratch(spark, "model")
    save(fitted, path)
    return _predictions(predict_knn(load(spark, path), test, EVALUATED_K))


def q_mae_knn(spark, d):
    fitted, test = _fitted(spark, d)
    return _metrics(mae(predict_knn(fitted, test, EVALUATED_K), "knn", EVALUATED_K))


def q_mae_knn_covered(spark, d):
    """Only test rows that some neighbour covers."""
    fitted, test = _fitted(spark, d)
    return _metrics(mae(predict_knn(fitted, test, EVALUATED_K, fallback="drop"), "knn"))


def _fit_on_test(spark, d) -> tuple[Fitted, DataFrame]:
    train, test = _split(spark, d)
    seen = stage(_seen(train, test), "seen")
    return fit(seen, means=user_means(train), stored=True), seen


def q_mae_cosine_on_test_deviations(spark, d):
    """Similarities and deviations taken from the test rows, around training means."""
    fitted, seen = _fit_on_test(spark, d)
    return _metrics(mae(predict_all_neighbors(fitted, seen, fallback="drop"), "cosine"))


def q_mae_jaccard_on_test_deviations(spark, d):
    fitted, seen = _fit_on_test(spark, d)
    return _metrics(mae(predict_all_neighbors(fitted, seen, pairs.JACCARD, fallback="drop"), "jaccard"))


def q_jaccard_minus_cosine(spark, d):
    """Both errors on the test rows' own deviations, and their difference."""
    fitted, seen = _fit_on_test(spark, d)
    rows = [mae(predict_all_neighbors(fitted, seen, m, fallback="drop"), m) for m in (pairs.COSINE, pairs.JACCARD)]
    return neat(compare(rows[0].unionByName(rows[1]), pairs.COSINE).drop("k"), mae=6, mae_minus_reference=6)


def q_mae_knn_on_test_deviations(spark, d):
    fitted, seen = _fit_on_test(spark, d)
    return neat(knn_sweep(fitted, seen, fallback="drop"), mae=6)


def q_knn_sweep(spark, d):
    fitted, test = _fitted(spark, d)
    return neat(knn_sweep(fitted, test), mae=6)


def q_knn_storage_by_k(spark, d):
    return edges_by_k(_fitted_all(spark, d))


def q_mae_by_k(spark, d):
    fitted, test = _fitted(spark, d)
    return neat(mae_by_k(fitted, test), mae=6)


def q_mae_by_k_hot(spark, d):
    fitted, test = _fitted(spark, d, HOT)
    return neat(mae_by_k(fitted, test), mae=6)


def q_lowest_k(spark, d):
    """Smallest k that beats the baseline, with deviations from train or from test rows."""
    train, test = _split(spark, d)
    fitted = fit(train, stored=True)
    seen = stage(_seen(train, test), "seen")
    on_test = fit(seen, means=user_means(train), stored=True)
    train_fit = lowest_k(mae_by_k(fitted, test), mae(predict_baseline(train, test), "baseline"))
    test_fit = lowest_k(
        mae_by_k(on_test, seen, fallback="drop"),
        mae(predict_baseline(train, seen, cold_items="drop", deviations_from=seen), "baseline"),
    )
    both = train_fit.select(F.lit("train").alias("deviations"), "*").unionByName(
        test_fit.select(F.lit("test").alias("deviations"), "*")
    )
    return neat(both, target_mae=6, mae=6)


def q_knn_full_table(spark, d):
    return neat(predict_table(_fitted_all(spark, d), NEIGHBORS), prediction=6)


# --- recommendation ----------------------------------------------------------


def _recommended(df: DataFrame) -> DataFrame:
    return neat(df, prediction=6)


def q_recommend_baseline(spark, d):
    return _recommended(recommend_baseline(
        _ratings(spark, d), _personal(spark, d), PERSONAL_USER, items=item_titles(spark, d)
    ))


def q_rank_all_items(spark, d):
    """Every item the user has not rated, ranked."""
    return _recommended(recommend_baseline(
        _ratings(spark, d), _personal(spark, d), PERSONAL_USER, n=None, items=item_titles(spark, d)
    ))


def q_recommend_popularity(spark, d):
    return _recommended(recommend_popular(
        _ratings(spark, d), _personal(spark, d), PERSONAL_USER, items=item_titles(spark, d)
    ))


def q_recommend_knn(spark, d):
    personal = _personal(spark, d)
    fitted = fit(_ratings(spark, d).unionByName(personal))
    target = personal.select("user_id").distinct()
    return _recommended(recommend_knn_for_ks(fitted, target, (30, 300), items=item_titles(spark, d)))


def q_recommend_knn_fold_in(spark, d):
    """The same for a user folded into a model that was fitted without it."""
    personal = _personal(spark, d)
    fitted = fold_in(_fitted_all(spark, d), personal)
    target = personal.select("user_id").distinct()
    return _recommended(recommend_knn_for_ks(fitted, target, (30, 300), items=item_titles(spark, d)))


def q_fold_in_vectors(spark, d):
    """Vectors after every seventh user turned its ratings round and every eleventh other one left."""
    ratings = _ratings(spark, d)
    turned = ratings.where("user_id % 7 = 0").withColumn("rating", 6 - F.col("rating"))
    left = ratings.where("user_id % 11 = 0 and user_id % 7 <> 0").select("user_id").distinct()
    rows = fold_in(fit(ratings, stored=True), turned, left).vectors
    return neat(rows.select("user_id", "item_id", "dev", "pdev"), dev=6, pdev=6)


def q_recommend_knn_all(spark, d):
    return _recommended(recommend_knn_all(_fitted_all(spark, d), NEIGHBORS))


# --- reports -----------------------------------------------------------------


def q_model_comparison(spark, d):
    train, test = _split(spark, d)
    report = model_comparison(train, test, fit(train, stored=True), (EVALUATED_K,))
    return neat(report, mae=6, mae_minus_reference=6)


def q_mean_model_differences(spark, d):
    train, test = _split(spark, d)
    rows = (
        mae(predict_global(train, test), "global")
        .unionByName(mae(predict_user_mean(train, test), "user"))
        .unionByName(mae(predict_item_mean(train, test), "item"))
    )
    return neat(compare(rows, "global").drop("k"), mae=6, mae_minus_reference=6)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_from_text": ratings_from_text,
    "ratings_from_tab_text": ratings_from_tab_text,
    "personal_from_csv": personal_from_csv,
    "metrics_json": metrics_json,
    "ratings_with_personal": ratings_with_personal,
    "rated_with_titles": rated_with_titles,
    "rating_stats": q_rating_stats,
    "user_means": q_user_means,
    "user_mean_stats": q_user_mean_stats,
    "item_mean_stats": q_item_mean_stats,
    "close_to_global_ratio": q_close_to_global_ratio,
    "item_popularity": q_item_popularity,
    "user_item_sets": q_user_item_sets,
    "cohort_item_sets": q_cohort_item_sets,
    "cohort_overlap": q_cohort_overlap,
    "mae_global": _mae_of(predict_global, "global"),
    "mae_user": _mae_of(predict_user_mean, "user"),
    "mae_item": _mae_of(predict_item_mean, "item"),
    "mae_baseline": _mae_of(predict_baseline, "baseline"),
    "mae_baseline_on_test_deviations": q_mae_baseline_on_test_deviations,
    "absolute_errors": q_absolute_errors,
    "normalized_deviation": q_normalized_deviation,
    "item_mean_deviation": q_item_mean_deviation,
    "baseline_prediction": q_baseline_prediction,
    "processed_deviation": q_processed_deviation,
    "cosine_similarity": _pairs_of(pairs.COSINE),
    "jaccard_similarity": _pairs_of(pairs.JACCARD),
    "pair_overlap": _pairs_of(pairs.OVERLAP),
    "overlap_stats": q_overlap_stats,
    "cosine_similarity_chosen_split": _pairs_of(pairs.COSINE, CHOSEN),
    "cosine_similarity_hot": _pairs_of(pairs.COSINE, HOT),
    "jaccard_similarity_hot": _pairs_of(pairs.JACCARD, HOT),
    "overlap_stats_hot": q_overlap_stats_hot,
    "pair_count_storage": q_pair_count_storage,
    "top_k_neighbors": q_top_k_neighbors,
    "top_k_neighbors_hot": q_top_k_neighbors_hot,
    "top_k_neighbors_skipping": q_top_k_neighbors_skipping,
    "neighbor_lists": q_neighbor_lists,
    "cosine_prediction": _all_neighbor_predictions(pairs.COSINE),
    "cosine_prediction_hot": _all_neighbor_predictions(pairs.COSINE, HOT),
    "jaccard_prediction": _all_neighbor_predictions(pairs.JACCARD),
    "mae_cosine": _mae_all_neighbors(pairs.COSINE),
    "mae_jaccard": _mae_all_neighbors(pairs.JACCARD),
    "mae_cosine_on_test_deviations": q_mae_cosine_on_test_deviations,
    "mae_jaccard_on_test_deviations": q_mae_jaccard_on_test_deviations,
    "jaccard_minus_cosine": q_jaccard_minus_cosine,
    "mae_knn_on_test_deviations": q_mae_knn_on_test_deviations,
    "knn_prediction": q_knn_prediction,
    "knn_prediction_for_users": q_knn_prediction_for_users,
    "knn_prediction_saved": q_knn_prediction_saved,
    "mae_knn": q_mae_knn,
    "mae_knn_covered": q_mae_knn_covered,
    "knn_sweep": q_knn_sweep,
    "knn_storage_by_k": q_knn_storage_by_k,
    "mae_by_k": q_mae_by_k,
    "mae_by_k_hot": q_mae_by_k_hot,
    "lowest_k": q_lowest_k,
    "knn_full_table": q_knn_full_table,
    "recommend_baseline": q_recommend_baseline,
    "rank_all_items": q_rank_all_items,
    "recommend_popularity": q_recommend_popularity,
    "recommend_knn": q_recommend_knn,
    "recommend_knn_fold_in": q_recommend_knn_fold_in,
    "fold_in_vectors": q_fold_in_vectors,
    "recommend_knn_all": q_recommend_knn_all,
    "mean_model_differences": q_mean_model_differences,
    "model_comparison": q_model_comparison,
}

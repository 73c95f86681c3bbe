"""DuckDB SQL for every registered query, written from the formulas.

The SQL shares nothing with the Spark plans: pairs come from a plain self-join, a
model evaluated at several k is evaluated once per k, and so on.
"""

from __future__ import annotations

#: Fixed value: the neighbourhood sizes the reference results are reported for.
KS = (10, 30, 50, 100, 200, 300, 400, 800, 943)


def rnd(expr: str, places: int) -> str:
    """Round half up.  Results at 6 places are rounded to 12 first: a value that is
    exactly halfway must not be decided by the last bit of a sum."""
    if places == 6:
        expr = f"(floor(({expr}) * 1e12 + 0.5) / 1e12)"
    return f"(floor(({expr}) * 1e{places} + 0.5) / 1e{places})"


def scale(x: str, a: str) -> str:
    return f"(CASE WHEN {x} > {a} THEN 5.0 - {a} WHEN {x} < {a} THEN {a} - 1.0 ELSE 1.0 END)"


def dev(r: str, a: str) -> str:
    return f"(CASE WHEN abs({r} - {a}) < 1e-9 THEN 0.0 ELSE ({r} - {a}) / nullif({scale(r, a)}, 0.0) END)"


def denorm(a: str, d: str) -> str:
    return f"({a} + {d} * {scale(f'({a} + {d})', a)})"


RATINGS = """ratings AS MATERIALIZED (
  SELECT o_custkey AS user_id, l_partkey AS item_id, avg(ceil(l_quantity / 10)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

SPLIT = RATINGS + """,
train AS MATERIALIZED (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 <> 0),
test AS MATERIALIZED (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 = 0),
user_mean AS MATERIALIZED (
  SELECT user_id, avg(rating) AS a, count(*) AS n FROM train GROUP BY 1),
item_mean AS MATERIALIZED (
  SELECT item_id, avg(rating) AS m, count(*) AS n FROM train GROUP BY 1),
seen AS MATERIALIZED (
  SELECT test.* FROM test JOIN item_mean USING (item_id) JOIN user_mean USING (user_id))"""

PERSONAL = """personal AS (
  SELECT CAST(-1 AS BIGINT) AS user_id, p_partkey AS item_id,
         CAST(1 + p_partkey % 5 AS DOUBLE) AS rating
  FROM part WHERE p_partkey % 7 = 1)"""


def vectors(rows: str = "train", means: str = "user_mean") -> str:
    """CTEs: v(user_id, item_id, rating, a, d), p = v + pd, sizes(user_id, n)."""
    return f"""v AS MATERIALIZED (
  SELECT r.user_id, r.item_id, r.rating, u.a, {dev('r.rating', 'u.a')} AS d
  FROM {rows} r JOIN {means} u USING (user_id)),
norms AS MATERIALIZED (SELECT user_id, sqrt(sum(d * d)) AS norm FROM v GROUP BY 1),
p AS MATERIALIZED (
  SELECT v.*, d / nullif(norm, 0.0) AS pd FROM v JOIN norms USING (user_id)),
sizes AS MATERIALIZED (SELECT user_id, count(*) AS n FROM v GROUP BY 1)"""


def similar(metric: str) -> str:
    """CTEs: s(user_id, neighbor_id, similarity) for u < v; e = both directions."""
    if metric == "cosine":
        body = f"""
  SELECT x.user_id, y.user_id AS neighbor_id, {rnd('sum(x.pd * y.pd)', 9)} AS similarity
  FROM p x JOIN p y ON x.item_id = y.item_id AND x.user_id < y.user_id
  WHERE x.pd IS NOT NULL AND y.pd IS NOT NULL GROUP BY 1, 2"""
    else:
        shared = """
  SELECT x.user_id, y.user_id AS neighbor_id, count(*) AS shared
  FROM v x JOIN v y ON x.item_id = y.item_id AND x.user_id < y.user_id GROUP BY 1, 2"""
        if metric == "overlap":
            body = f"SELECT user_id, neighbor_id, CAST(shared AS DOUBLE) AS similarity FROM ({shared})"
        else:
            body = f"""
  SELECT o.user_id, o.neighbor_id,
         {rnd('shared / (a.n + b.n - shared)', 9)} AS similarity
  FROM ({shared}) o JOIN sizes a ON a.user_id = o.user_id
  JOIN sizes b ON b.user_id = o.neighbor_id"""
    return f"""s AS MATERIALIZED ({body}),
e AS MATERIALIZED (
  SELECT user_id, neighbor_id, similarity FROM s
  UNION ALL SELECT neighbor_id, user_id, similarity FROM s)"""


RANKED = """ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY similarity DESC, neighbor_id) AS rank FROM e)"""


def predicted(edges: str, test: str = "test", keep: bool = True) -> str:
    """CTE predicted(user_id, item_id, rating, prediction) from weighted sums over edges."""
    fallback = "u.a" if keep else "NULL"
    return f"""w AS MATERIALIZED (
  SELECT t.user_id, t.item_id, sum(g.similarity * v.d) / nullif(sum(abs(g.similarity)), 0.0) AS wd
  FROM {test} t JOIN v ON v.item_id = t.item_id
  JOIN ({edges}) g ON g.user_id = t.user_id AND g.neighbor_id = v.user_id GROUP BY 1, 2),
users AS (SELECT DISTINCT user_id, a FROM v),
predicted AS MATERIALIZED (
  SELECT t.user_id, t.item_id, t.rating,
         CASE WHEN wd IS NULL THEN {fallback} ELSE {denorm('u.a', 'wd')} END AS prediction
  FROM {test} t JOIN users u USING (user_id) LEFT JOIN w USING (user_id, item_id))"""


PREDICTIONS = f"""SELECT user_id, item_id, {rnd('rating', 6)} AS rating,
  {rnd('prediction', 6)} AS prediction FROM predicted"""


def mae(model: str, source: str = "predicted") -> str:
    return f"""SELECT '{model}' AS model, count(prediction) AS n,
  {rnd('avg(abs(rating - prediction))', 6)} AS mae FROM {source}"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def spread(value: str, table: str) -> str:
    near = f"({value} < g.g + 0.5 AND {value} > g.g - 0.5)"
    return f"""count(*) AS groups, {rnd(f'min({value})', 6)} AS min, {rnd(f'max({value})', 6)} AS max,
  {rnd(f'(min({value}) + max({value})) / 2', 6)} AS midrange, {rnd(f'avg({value})', 6)} AS average,
  {rnd(f'avg(CASE WHEN {near} THEN 1.0 ELSE 0.0 END)', 6)} AS ratio_close,
  bool_and({near}) AS all_close FROM {table}, g"""


ALL_MEANS = RATINGS + """,
g AS (SELECT avg(rating) AS g FROM ratings),
um AS (SELECT user_id, avg(rating) AS m, count(*) AS n FROM ratings GROUP BY 1),
im AS (SELECT item_id, avg(rating) AS m, count(*) AS n FROM ratings GROUP BY 1)"""

GLOBAL = "gp AS (SELECT *, (SELECT avg(rating) FROM train) AS prediction FROM test)"
USER = "up AS (SELECT test.*, a AS prediction FROM test JOIN user_mean USING (user_id))"
ITEM = "ip AS (SELECT test.*, m AS prediction FROM test JOIN item_mean USING (item_id))"


def baseline(rows: str = "v", test: str = "test", how: str = "LEFT JOIN") -> str:
    return f"""bd AS (SELECT item_id, avg(d) AS bd FROM {rows} GROUP BY 1),
bp AS MATERIALIZED (
  SELECT t.user_id, t.item_id, t.rating, {denorm('u.a', 'coalesce(bd, 0.0)')} AS prediction
  FROM {test} t JOIN user_mean u USING (user_id) {how} bd USING (item_id))"""


def curve(test: str, keep: bool) -> str:
    """CTE curve(k, n, mae): the MAE at every k at which some prediction changes."""
    start = "abs(t.rating - u.a)" if keep else "NULL"
    ks = "SELECT DISTINCT rank AS k FROM steps" + (" UNION SELECT 1" if keep else "")
    return f"""users AS (SELECT DISTINCT user_id, a FROM v),
terms AS MATERIALIZED (
  SELECT t.user_id, t.item_id, t.rating, u.a, r.rank,
         sum(similarity * d) OVER c AS num, sum(abs(similarity)) OVER c AS den
  FROM {test} t JOIN users u USING (user_id) JOIN v ON v.item_id = t.item_id
  JOIN ranked r ON r.user_id = t.user_id AND r.neighbor_id = v.user_id
  WINDOW c AS (PARTITION BY t.user_id, t.item_id ORDER BY r.rank)),
steps AS MATERIALIZED (
  SELECT user_id, item_id, rank,
         CASE WHEN den = 0 THEN {'abs(rating - a)' if keep else 'NULL'}
              ELSE abs(rating - {denorm('a', '(num / nullif(den, 0.0))')}) END AS err
  FROM terms),
ks AS ({ks}),
grid AS (
  SELECT t.user_id, t.item_id, {start} AS start, ks.k
  FROM {test} t JOIN users u USING (user_id), ks),
curve AS MATERIALIZED (
  SELECT k, count(coalesce(err, start)) AS n, avg(coalesce(err, start)) AS mae
  FROM grid ASOF LEFT JOIN steps
    ON grid.user_id = steps.user_id AND grid.item_id = steps.item_id AND grid.k >= steps.rank
  GROUP BY k)"""


def sweep(test: str = "test", keep: bool = True) -> str:
    ks = ", ".join(f"({k})" for k in KS)
    fallback = "u.a" if keep else "NULL"
    return f"""ks(k) AS (VALUES {ks}),
w AS MATERIALIZED (
  SELECT ks.k, t.user_id, t.item_id,
         sum(g.similarity * v.d) / nullif(sum(abs(g.similarity)), 0.0) AS wd
  FROM {test} t JOIN v ON v.item_id = t.item_id
  JOIN ranked g ON g.user_id = t.user_id AND g.neighbor_id = v.user_id
  JOIN ks ON g.rank <= ks.k GROUP BY 1, 2, 3),
users AS (SELECT DISTINCT user_id, a FROM v),
predicted AS (
  SELECT ks.k, t.rating,
         CASE WHEN wd IS NULL THEN {fallback} ELSE {denorm('u.a', 'wd')} END AS prediction
  FROM {test} t JOIN users u USING (user_id) CROSS JOIN ks
  LEFT JOIN w ON w.k = ks.k AND w.user_id = t.user_id AND w.item_id = t.item_id)"""


BY_K = f"""SELECT k, count(prediction) AS n, {rnd('avg(abs(rating - prediction))', 6)} AS mae
FROM predicted GROUP BY k"""


def recommended(candidates: str, n: int = 5, extra: str = "", titles: bool = True) -> str:
    """Rank (user_id, item_id, prediction) candidates; keep the n best."""
    title = ", p_name AS title" if titles else ""
    join = "LEFT JOIN part ON p_partkey = item_id" if titles else ""
    return f"""SELECT user_id, item_id, {rnd('prediction', 6)} AS prediction, rank{title}{extra}
FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY floor(prediction * 1e9 + 0.5) DESC, item_id) AS rank
      FROM ({candidates}) c) {join} WHERE rank <= {n}"""


def knn_candidates(k: int, rated: str) -> str:
    return f"""SELECT w.user_id, w.item_id, {denorm('u.a', 'wd')} AS prediction
  FROM (SELECT g.user_id, v.item_id,
               sum(g.similarity * v.d) / nullif(sum(abs(g.similarity)), 0.0) AS wd
        FROM ranked g JOIN v ON v.user_id = g.neighbor_id WHERE g.rank <= {k} GROUP BY 1, 2) w
  JOIN (SELECT DISTINCT user_id, a FROM v) u ON u.user_id = w.user_id
  WHERE wd IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM {rated} r WHERE r.user_id = w.user_id AND r.item_id = w.item_id)"""


def personal_candidates(weight: str = "") -> str:
    return f"""SELECT CAST(-1 AS BIGINT) AS user_id, item_id, {weight}{denorm('mine.a', 'bd')} AS prediction
  FROM (SELECT item_id, avg(d) AS bd, count(*) AS n FROM v GROUP BY 1) b,
       (SELECT avg(rating) AS a FROM personal) mine,
       (SELECT max(c) AS most FROM (SELECT count(*) AS c FROM ratings GROUP BY item_id)) m
  WHERE item_id NOT IN (SELECT item_id FROM personal)"""


ALL_USERS = "all_mean AS (SELECT user_id, avg(rating) AS a FROM ratings GROUP BY 1)"
COHORTS = """c AS MATERIALIZED (
  SELECT CAST(CAST(floor(a) AS BIGINT) AS VARCHAR) || '/' || CAST(user_id % 2 AS VARCHAR) AS cohort, item_id
  FROM ratings JOIN all_mean USING (user_id))"""
TRAIN = (SPLIT, vectors())
TEST_FIT = (SPLIT, vectors("seen", "user_mean"))
COSINE = (*TRAIN, similar("cosine"))
JACCARD = (*TRAIN, similar("jaccard"))
WHOLE = (RATINGS, ALL_USERS, vectors("ratings", "all_mean"))
ALL_COSINE = (*WHOLE, similar("cosine"))
ALL_JACCARD = (*WHOLE, similar("jaccard"))
ALL_EDGES = "SELECT * FROM e"
K100 = "SELECT * FROM ranked WHERE rank <= 100"


def model_comparison() -> str:
    """Every model in one statement; cosine and Jaccard pairs get names of their own."""
    jaccard = (
        similar("jaccard").replace("s AS", "sj AS").replace("e AS", "ej AS").replace("FROM s\n", "FROM sj\n")
        .replace("FROM s)", "FROM sj)")
    )

    def named(edges: str, suffix: str) -> str:
        text = predicted(edges).replace("predicted AS", f"predicted_{suffix} AS")
        text = text.replace("w AS", f"w_{suffix} AS").replace("LEFT JOIN w ", f"LEFT JOIN w_{suffix} ")
        return text.replace("users AS", f"users_{suffix} AS").replace("JOIN users u", f"JOIN users_{suffix} u")

    def metric(model: str, k: str, source: str) -> str:
        return f"""SELECT '{model}' AS model, {k} AS k, count(prediction) AS n,
    avg(abs(rating - prediction)) AS mae FROM {source}"""

    rows = " UNION ALL ".join([
        metric("global", "NULL", "gp"), metric("user", "NULL", "up"), metric("item", "NULL", "ip"),
        metric("baseline", "NULL", "bp"), metric("cosine", "NULL", "predicted_c"),
        metric("jaccard", "NULL", "predicted_j"), metric("knn", "100", "predicted_k"),
    ])
    return with_(
        *COSINE, RANKED, jaccard, GLOBAL, USER, ITEM, baseline(),
        named(ALL_EDGES, "c"), named("SELECT * FROM ej", "j"), named(K100, "k"), f"m AS ({rows})",
        select=f"""SELECT model, CAST(k AS INTEGER) AS k, n, {rnd('mae', 6)} AS mae,
  {rnd("mae - (SELECT mae FROM m WHERE model = 'baseline')", 6)} AS mae_minus_reference FROM m""",
    )


def lowest(test: str, keep: bool, target: str, label: str) -> str:
    return f"""SELECT '{label}' AS deviations, {rnd('target', 6)} AS target_mae,
  (SELECT min(k) FROM curve WHERE mae < target) AS k,
  {rnd('(SELECT mae FROM curve WHERE k = (SELECT min(k) FROM curve WHERE mae < target))', 6)} AS mae
FROM (SELECT avg(abs(rating - prediction)) AS target FROM bp) x"""


def lowest_k() -> str:
    train = with_(*COSINE, RANKED, curve("test", True), baseline(),
                  select=lowest("test", True, "bp", "train"))
    test = with_(*TEST_FIT, similar("cosine"), RANKED, curve("seen", False),
                 baseline("v", "seen", "JOIN"), select=lowest("seen", False, "bp", "test"))
    return f"SELECT * FROM ({train}) UNION ALL SELECT * FROM ({test})"


ORACLE: dict[str, str] = {
    "ratings_from_text": with_(
        RATINGS, select=f"SELECT user_id, item_id, {rnd('rating', 6)} AS rating FROM ratings"),
    "personal_from_csv": """SELECT p_partkey AS item_id, p_name || ', the' AS title,
  CASE WHEN p_partkey % 7 = 1 THEN CAST(1 + p_partkey % 5 AS DOUBLE) END AS rating FROM part""",
    "metrics_json": with_(SPLIT, USER, select=mae("user", "up")),
    "ratings_with_personal": with_(RATINGS, PERSONAL, select=f"""
SELECT user_id, {rnd('avg(rating)', 6)} AS user_mean, count(*) AS n
FROM (SELECT * FROM ratings UNION ALL SELECT * FROM personal) GROUP BY 1"""),
    "rated_with_titles": with_(PERSONAL, select="""
SELECT item_id, user_id, rating, p_name AS title FROM personal JOIN part ON p_partkey = item_id"""),
    "rating_stats": with_(ALL_MEANS, select=f"""
SELECT 'user' AS grouped_by, {rnd('any_value(g.g)', 6)} AS global_mean, {spread('m', 'um')}
UNION ALL
SELECT 'item' AS grouped_by, {rnd('any_value(g.g)', 6)} AS global_mean, {spread('m', 'im')}"""),
    "user_means": with_(ALL_MEANS, select=f"SELECT user_id, {rnd('m', 6)} AS user_mean, n FROM um"),
    "user_mean_stats": with_(ALL_MEANS, select=f"SELECT {spread('m', 'um')}"),
    "item_mean_stats": with_(ALL_MEANS, select=f"SELECT {spread('m', 'im')}"),
    "close_to_global_ratio": with_(ALL_MEANS, select=f"""
SELECT grouped_by, groups, ratio_close, all_close FROM (
  SELECT 'user' AS grouped_by, {spread('m', 'um')} UNION ALL SELECT 'item', {spread('m', 'im')})"""),
    "item_popularity": with_(ALL_MEANS, select=f"""
SELECT item_id, {rnd('m', 6)} AS item_mean, n,
  {rnd('n / (SELECT max(n) FROM im)', 6)} AS share_of_max FROM im"""),
    "user_item_sets": with_(RATINGS, select="""
SELECT user_id, item_id, count(*) OVER (PARTITION BY user_id) AS set_size FROM ratings"""),
    "cohort_item_sets": with_(RATINGS, ALL_USERS, COHORTS, select="""
SELECT cohort, count(DISTINCT item_id) AS set_size FROM c GROUP BY 1
UNION ALL SELECT split_part(cohort, '/', 1), count(DISTINCT item_id) FROM c GROUP BY 1"""),
    "cohort_overlap": with_(RATINGS, ALL_USERS, COHORTS, """s AS (SELECT DISTINCT cohort, item_id FROM c),
n AS (SELECT cohort, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT x.cohort AS a, y.cohort AS b, count(*) AS shared FROM s x JOIN s y USING (item_id) GROUP BY 1, 2)""", select=f"""
SELECT x.cohort AS a, y.cohort AS b, coalesce(shared, 0) AS shared, x.n + y.n - coalesce(shared, 0) AS joint,
  {rnd('coalesce(shared, 0) / (x.n + y.n - coalesce(shared, 0))', 6)} AS jaccard
FROM n x JOIN n y ON x.cohort < y.cohort LEFT JOIN o ON o.a = x.cohort AND o.b = y.cohort"""),
    "mae_global": with_(SPLIT, GLOBAL, select=mae("global", "gp")),
    "mae_user": with_(SPLIT, USER, select=mae("user", "up")),
    "mae_item": with_(SPLIT, ITEM, select=mae("item", "ip")),
    "mae_baseline": with_(*TRAIN, baseline(), select=mae("baseline", "bp")),
    "mae_baseline_on_test_deviations": with_(
        *TEST_FIT, baseline("v", "seen", "JOIN"), select=mae("baseline", "bp")),
    "absolute_errors": with_(SPLIT, USER, select=f"""
SELECT user_id, item_id, {rnd('abs(rating - prediction)', 6)} AS error FROM up"""),
    "normalized_deviation": with_(*WHOLE, select=f"""
SELECT user_id, item_id, {rnd('rating', 6)} AS rating, {rnd('a', 6)} AS user_mean,
  {rnd('d', 6)} AS dev FROM v"""),
    "item_mean_deviation": with_(*WHOLE, select=f"""
SELECT item_id, {rnd('avg(d)', 6)} AS item_dev, count(*) AS n FROM v GROUP BY 1"""),
    "baseline_prediction": with_(*TRAIN, baseline(), select=PREDICTIONS.replace("predicted", "bp")),
    "processed_deviation": with_(*WHOLE, select=f"""
SELECT user_id, item_id, {rnd('d', 6)} AS dev, {rnd('pd', 6)} AS pdev FROM p"""),
    "cosine_similarity": with_(*ALL_COSINE, select="SELECT * FROM s"),
    "jaccard_similarity": with_(*ALL_JACCARD, select="SELECT * FROM s"),
    "pair_overlap": with_(*WHOLE, similar("overlap"), select="SELECT * FROM s"),
    "overlap_stats": with_(*WHOLE, similar("overlap"), select=f"""
SELECT users, pairs, overlapping_pairs,
  CAST(CASE WHEN overlapping_pairs < pairs THEN 0 ELSE lo END AS BIGINT) AS min,
  CAST(hi AS BIGINT) AS max, {rnd('total / pairs', 6)} AS average,
  {rnd('sqrt((squares + (pairs - overlapping_pairs) * (total / pairs) ** 2) / pairs)', 6)} AS stddev
FROM (
  SELECT any_value(u) AS users, any_value(u * (u - 1) // 2) AS pairs,
    count(*) AS overlapping_pairs, min(similarity) AS lo, max(similarity) AS hi,
    sum(similarity) AS total,
    sum((similarity - mean) ** 2) AS squares
  FROM s, (SELECT count(*) AS u FROM sizes) c,
    (SELECT (SELECT sum(similarity) FROM s) / (count(*) * (count(*) - 1) / 2) AS mean FROM sizes) m)"""),
    "pair_count_storage": with_(*ALL_COSINE, select="""
SELECT u AS users, u * (u - 1) // 2 AS pairs, 8 * (u * (u - 1) // 2) AS bytes,
  nonzero AS nonzero_pairs, 8 * nonzero AS nonzero_bytes
FROM (SELECT count(*) AS u FROM sizes) a, (SELECT count(*) AS nonzero FROM s WHERE similarity <> 0) b"""),
    "top_k_neighbors": with_(*ALL_COSINE, RANKED, select="SELECT * FROM ranked WHERE rank <= 10"),
    "neighbor_lists": with_(*ALL_COSINE, RANKED, select="""
SELECT user_id, string_agg(CAST(neighbor_id AS VARCHAR), ',' ORDER BY rank) AS neighbors
FROM ranked WHERE rank <= 10 GROUP BY 1"""),
    "cosine_prediction": with_(*COSINE, predicted(ALL_EDGES), select=PREDICTIONS),
    "jaccard_prediction": with_(*JACCARD, predicted(ALL_EDGES), select=PREDICTIONS),
    "mae_cosine": with_(*COSINE, predicted(ALL_EDGES), select=mae("cosine")),
    "mae_jaccard": with_(*JACCARD, predicted(ALL_EDGES), select=mae("jaccard")),
    "mae_cosine_on_test_deviations": with_(
        *TEST_FIT, similar("cosine"), predicted(ALL_EDGES, "seen", False), select=mae("cosine")),
    "mae_knn_on_test_deviations": with_(
        *TEST_FIT, similar("cosine"), RANKED, sweep("seen", False), select=BY_K),
    "knn_prediction": with_(*COSINE, RANKED, predicted(K100), select=PREDICTIONS),
    "mae_knn": with_(*COSINE, RANKED, predicted(K100), select=mae("knn")),
    "mae_knn_covered": with_(*COSINE, RANKED, predicted(K100, keep=False), select=mae("knn")),
    "knn_sweep": with_(*COSINE, RANKED, sweep(), select=BY_K),
    "knn_storage_by_k": with_(*ALL_COSINE, RANKED, select="""
SELECT k, count(*) AS edges, 8 * count(*) AS bytes FROM ranked
JOIN (VALUES """ + ", ".join(f"({k})" for k in KS) + """) ks(k) ON rank <= k GROUP BY k"""),
    "mae_by_k": with_(*COSINE, RANKED, curve("test", True), select=f"""
SELECT k, n, {rnd('mae', 6)} AS mae FROM curve"""),
    "lowest_k": lowest_k(),
    "knn_full_table": with_(*ALL_COSINE, RANKED, select=f"""
SELECT w.user_id, w.item_id, {rnd(denorm('u.a', 'wd'), 6)} AS prediction
FROM (SELECT g.user_id, v.item_id,
             sum(g.similarity * v.d) / nullif(sum(abs(g.similarity)), 0.0) AS wd
      FROM ranked g JOIN v ON v.user_id = g.neighbor_id WHERE g.rank <= 10 GROUP BY 1, 2) w
JOIN all_mean u ON u.user_id = w.user_id WHERE wd IS NOT NULL"""),
    "recommend_baseline": with_(
        RATINGS, PERSONAL, ALL_USERS, vectors("ratings", "all_mean"),
        select=recommended(personal_candidates())),
    "rank_all_items": with_(
        RATINGS, PERSONAL, ALL_USERS, vectors("ratings", "all_mean"),
        select=recommended(personal_candidates()).removesuffix("WHERE rank <= 5")),
    "recommend_popularity": with_(
        RATINGS, PERSONAL, ALL_USERS, vectors("ratings", "all_mean"),
        select=recommended(personal_candidates("n / most * "))),
    "recommend_knn": with_(
        RATINGS, PERSONAL,
        "together AS MATERIALIZED (SELECT * FROM ratings UNION ALL SELECT * FROM personal)",
        "all_mean AS (SELECT user_id, avg(rating) AS a FROM together GROUP BY 1)",
        vectors("together", "all_mean"), similar("cosine"),
        RANKED.replace("FROM e", "FROM e WHERE user_id = -1"),
        select="SELECT * FROM (" + recommended(knn_candidates(30, "personal"), extra=", 30 AS k")
        + ") UNION ALL SELECT * FROM ("
        + recommended(knn_candidates(300, "personal"), extra=", 300 AS k") + ")",
    ),
    "recommend_knn_all": with_(
        *ALL_COSINE, RANKED, select=recommended(knn_candidates(10, "ratings"), titles=False)),
    "mean_model_differences": with_(SPLIT, GLOBAL, USER, ITEM, """m AS (
  SELECT 'global' AS model, count(*) AS n, avg(abs(rating - prediction)) AS mae FROM gp
  UNION ALL SELECT 'user', count(*), avg(abs(rating - prediction)) FROM up
  UNION ALL SELECT 'item', count(*), avg(abs(rating - prediction)) FROM ip)""", select=f"""
SELECT model, n, {rnd('mae', 6)} AS mae,
  {rnd("mae - (SELECT mae FROM m WHERE model = 'global')", 6)} AS mae_minus_reference FROM m"""),
    "model_comparison": model_comparison(),
}

#: The same results whatever the settings that divide the work.
ORACLE |= {f"{name}_hot": ORACLE[name] for name in (
    "cosine_similarity", "jaccard_similarity", "overlap_stats", "top_k_neighbors", "cosine_prediction", "mae_by_k",
)}
ORACLE["top_k_neighbors_skipping"] = ORACLE["top_k_neighbors"]
ORACLE["cosine_similarity_chosen_split"] = ORACLE["cosine_similarity"]
ORACLE["knn_prediction_saved"] = ORACLE["knn_prediction"]
ORACLE["recommend_knn_fold_in"] = ORACLE["recommend_knn"]
ORACLE["fold_in_vectors"] = with_(
    RATINGS, """changed AS MATERIALIZED (
  SELECT user_id, item_id, CASE WHEN user_id % 7 = 0 THEN 6 - rating ELSE rating END AS rating
  FROM ratings WHERE user_id % 7 = 0 OR user_id % 11 <> 0)""",
    "changed_mean AS (SELECT user_id, avg(rating) AS a FROM changed GROUP BY 1)", vectors("changed", "changed_mean"),
    select=f"SELECT user_id, item_id, {rnd('d', 6)} AS dev, {rnd('pd', 6)} AS pdev FROM p",
)
ORACLE["ratings_from_tab_text"] = ORACLE["ratings_from_text"]
ORACLE["knn_prediction_for_users"] = ORACLE["knn_prediction"] + " WHERE user_id % 50 = 0"
_ON_TEST = {
    m: with_(*TEST_FIT, similar(m), predicted(ALL_EDGES, "seen", False), select=f"""
SELECT '{m}' AS model, count(prediction) AS n, avg(abs(rating - prediction)) AS mae FROM predicted""")
    for m in ("cosine", "jaccard")
}
ORACLE["mae_jaccard_on_test_deviations"] = f"SELECT model, n, {rnd('mae', 6)} AS mae FROM ({_ON_TEST['jaccard']}) x"
ORACLE["jaccard_minus_cosine"] = f"""SELECT x.model, x.n, {rnd('x.mae', 6)} AS mae, {rnd('x.mae - c.mae', 6)} AS mae_minus_reference
FROM (SELECT * FROM ({_ON_TEST['cosine']}) y UNION ALL SELECT * FROM ({_ON_TEST['jaccard']}) z) x, ({_ON_TEST['cosine']}) c"""

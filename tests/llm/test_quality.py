"""Base rules against brute force; trees against a plain walk, monotonic constraints, held-out accuracy."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kindred.llm import quality
from kindred.llm.quality import COUNTS, DEPTH, FEATURES, boost, features

DOCS, LABELS = "doc_id long, text string, score string, kept string, n_words string", "doc_id long, quality int, good int, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def judged(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)
    marks = spark.createDataFrame([(i, q, 1, "x") for i, q in labels], LABELS)
    return quality.judge(docs, marks).collect()


def texts():
    rnd = random.Random(2)
    words = ["a", "bb", "Ccc", "é#", "ñ|", "<x>", "𝄞𝄞", " ", "end.", "1"]
    rows = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60))) + rnd.choice(["", "\nsame line\nsame line", "\n \n\n", "\r\nx\r\nx"]) for _ in range(80)]
    return rows + [None, "", " \t\n", "a b c a b c", "a b", "a a a a", "word", "x " * 60, "a b c d\n" * 300, "\x85\xa0 z", "q" * 70_000, "many words here " * 20_000]


def test_base_columns_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    out = {r.doc_id: r for r in judged(spark, rows, [])}
    for i, text in rows:
        r, want = out[i], brute(text)
        assert tuple(r[c] for c in COUNTS[:5]) == want, (i, text)
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.score == 1 and r.kept == (not r.base_failed)
    assert len(out) == len(rows)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a b"), (1, "x"), (1, "x"), (1, "other"), (2, None)]
    out = judged(spark, rows, [(1, 1), (1, 0), (None, 0), (2, None), (77, 1)])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words) for r in out) == [(False, 1, 1), (False, 1, 1), (False, 1, 1), (False, 2, 0), (True, 0, 2)]
    assert judged(spark, [], []) == [] and judged(spark, [], [(1, 1)]) == []


def walk(model, tree, row):
    node = model.roots[tree]
    while model.left[node] != node:
        node = model.left[node] if row[model.feature[node]] <= model.cut[node] else model.right[node]
    return model.value[node]


def sample(seed, count=600):
    rnd = np.random.default_rng(seed)
    x = rnd.random((count, len(FEATURES)))
    good = x[:, 0] + 0.5 * np.sin(9 * x[:, 4]) + 0.2 * rnd.normal(size=count) < 0.7
    return x, good


def test_flattened_trees_equal_a_plain_walk():
    x, good = sample(1)
    model = boost(x, good, np.array(list(FEATURES.values())), trees=12)
    plain = [sum(walk(model, t, row) for t in range(len(model.roots))) for row in x]
    assert np.allclose(model.margins(x), plain) and len(model.roots) == 12 and len(model.feature) <= 12 * (2 ** (DEPTH + 1) - 1)
    assert ((model.score(x) >= 0.5) == good).mean() > 0.85


def test_constraints_hold_everywhere():
    x, good = sample(3)
    # Labels that contradict the constraint on the first feature.
    model = boost(x, ~good, np.array(list(FEATURES.values())), trees=30)
    grid = np.repeat(x[:50], 40, axis=0)
    for feature, sign in enumerate(FEATURES.values()):
        if sign:
            moved = grid.copy()
            moved[:, feature] = np.tile(np.linspace(-1, 2, 40), 50)
            steps = np.diff(model.margins(moved).reshape(50, 40), axis=1)
            assert (sign * steps >= -1e-9).all()
    free = grid.copy()
    free[:, 4] = np.tile(np.linspace(-1, 2, 40), 50)
    steps = np.diff(model.margins(free).reshape(50, 40), axis=1)
    assert (steps > 1e-9).any() and (steps < -1e-9).any()


def test_one_class_or_constant_features():
    x, good = sample(4, 50)
    model = boost(np.ones_like(x), good, np.array(list(FEATURES.values())), trees=3)
    assert np.isfinite(model.margins(x)).all()


def test_the_order_of_rows_does_not_matter(spark):
    x, good = sample(5, 200)
    schema = ", ".join(f"{c} long" for c in COUNTS) + ", good boolean"
    rows = [(*[int(100 * v) for v in r], int(50 * r[0]), bool(g)) for r, g in zip(x, good)]
    models = [quality.fit(spark.createDataFrame(order, schema)) for order in (rows, rows[::-1])]
    assert all(np.array_equal(getattr(models[0], c), getattr(models[1], c)) for c in ("feature", "cut", "left", "value"))


def test_held_out_accuracy(spark, small_dir):
    base = small_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    out = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    rates = out.groupBy("quality").agg(F.avg((F.col("score") >= 0.5).cast("double")).alias("good")).collect()
    rates = {r.quality: r.good for r in rates}
    assert rates[1] > 0.99 and rates[0] < 0.03

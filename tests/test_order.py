"""Whole orders ranked in ranges, and item sets as bitmaps, against plain Python."""

import random
import re

from pyspark.sql import functions as F

from kindred.operators.bitmaps import item_bitmaps, set_overlaps, set_sizes, united
from kindred.operators.neighbors import rank_long_lists
from kindred.operators.order import rank_in_ranges
from kindred.plans.recommend import top_n

EDGES = "user_id bigint, neighbor_id bigint, similarity double"


def ranked(rows):
    place, out = {}, set()
    for user, neighbor, similarity in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
        place[user] = place.get(user, 0) + 1
        out.add((user, neighbor, similarity, place[user]))
    return out


def test_long_lists_with_one_value_for_all(spark):
    rnd = random.Random(1)
    rows = [(1, n, 1.0) for n in range(20_000)] + [(2, n, rnd.choice([0.5, 1.0])) for n in range(50)] + [(3, 1, -0.5)]
    rnd.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        edges = spark.createDataFrame(rows, EDGES)
        assert {tuple(r) for r in rank_long_lists(edges).collect()} == ranked(rows)
        # No range holds much more than its share of the one long list.
        ranges = edges.repartitionByRange(F.asc("user_id"), F.desc("similarity"), F.asc("neighbor_id"))
        sizes = ranges.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert len(sizes) == 16 and sizes.max() < 3 * len(rows) / 16
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_all_rows_are_ranked_without_a_window_over_all(spark, capsys):
    rows = [(i, float(i % 7), "x") for i in range(3_000)]
    out = rank_in_ranges(spark.createDataFrame(rows, "item_id bigint, prediction double, rank string").drop("rank"),
                         [F.desc("prediction"), F.asc("item_id")])
    expected = {i: at for at, (i, *_) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert {r.item_id: r.rank for r in out.collect()} == expected
    out.explain()
    assert re.search(r"Window.*?Exchange (\w+)\(__range", capsys.readouterr().out, re.S).group(1) == "hashpartitioning"


def test_ranks_of_nothing_and_of_null_groups(spark):
    assert rank_long_lists(spark.createDataFrame([], EDGES)).count() == 0
    rows = spark.createDataFrame([(None, 1, 0.5), (None, 2, 0.9), (4, 1, None), (4, 2, 0.1)], EDGES)
    assert {(r.user_id, r.neighbor_id, r.rank) for r in rank_long_lists(rows).collect()} == {(None, 2, 1), (None, 1, 2), (4, 2, 1), (4, 1, 2)}


def test_all_items_of_each_user(spark):
    rows = [(u, i, float((i * 37) % 11)) for u in range(3) for i in range(100)]
    scored = spark.createDataFrame(rows, "user_id bigint, item_id bigint, prediction double")
    whole = {(r.user_id, r.item_id): r["rank"] for r in top_n(scored, None).collect()}
    cut = {(r.user_id, r.item_id): r["rank"] for r in top_n(scored, 5).collect()}
    assert len(whole) == 300 and cut == {k: v for k, v in whole.items() if v <= 5}


def test_bitmaps_equal_sets(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("abcd"), rnd.choice([rnd.randrange(200), rnd.randrange(10**6), -rnd.randrange(1, 10**5)])) for _ in range(4_000)]
    rows += rows[:50] + [("a", None), ("e", 2**62), ("f", None), (None, 5)]
    sets = {}
    for group, item in rows:
        if item is not None:
            sets.setdefault(group, set()).add(item)
    bitmaps = item_bitmaps(spark.createDataFrame(rows, "g string, item_id bigint"), "g")
    assert {r.g: r.set_size for r in set_sizes(bitmaps, "g").collect()} == {g: len(s) for g, s in sets.items()}
    halves = united(bitmaps.withColumn("half", F.col("g").isin("a", "b")), "half").where("half")
    assert set_sizes(halves, "half").first().set_size == len(sets["a"] | sets["b"])
    wanted = [(a, b) for a in "abcdef" for b in "abcdef"] + [("a", "b"), ("a", None)]
    found = set_overlaps(bitmaps, "g", spark.createDataFrame(wanted, "a string, b string"))
    assert {(r.a, r.b): (r.shared, r.joint, r.jaccard) for r in found.collect()} == {
        (a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b]), len(sets[a] & sets[b]) / len(sets[a] | sets[b]))
        for a in "abcde" for b in "abcde" if a != b
    }


def test_bitmaps_of_nothing(spark):
    empty = item_bitmaps(spark.createDataFrame([], "g string, item_id bigint"), "g")
    assert empty.count() == 0 and set_sizes(empty, "g").count() == 0
    assert set_overlaps(empty, "g", spark.createDataFrame([("a", "b")], "a string, b string")).count() == 0

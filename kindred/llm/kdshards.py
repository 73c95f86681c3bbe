"""Sharding by a k-d tree over document metadata, with exactly balanced bytes.

The coordinates of a group of equal texts are its size, its language, its source and its
smallest doc_id, each a long whose low bits hold a hash of the text, so that a cut can fall
between documents that agree in a coordinate.  A node of the tree is cut across its widest
coordinate (relative to the whole table) at a weighted median: distributed sums over 1,024
buckets of the coordinate find the bucket that holds the cut, and again inside it.  A node
for n shards is cut in the proportion of the capacities of its two halves; leaves are shards, each within its
target of bytes.

Groups of equal texts stay together.  Those heavier than 1/64 of a shard, 512 at most, are
dealt to shards first, largest first, and the tree fills up the rest; a group heavier than
a shard's target is cut by doc_id like any other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.sources.staging import stage

COORDINATES = ("c_size", "c_lang", "c_source", "c_id")
_BUCKETS = 1024
_TIE_BITS = 24
_SLOT_ROWS = 4096


def _tied(value: Column, tie: Column) -> Column:
    """``value`` (below 2**38) in the high bits, hash bits below."""
    return F.shiftleft(value.cast("long"), _TIE_BITS) + F.pmod(tie, F.lit(1 << _TIE_BITS))


def _groups(rows: DataFrame) -> DataFrame:
    """One row per group: ga, gb (its key), weight, and the coordinates."""
    named = lambda c: F.crc32(F.coalesce(F.col(c), F.lit("")).cast("binary"))
    grouped = rows.groupBy("ga", "gb").agg(
        F.sum("size").alias("weight"), F.min("size").alias("size"), F.min("lang").alias("lang"),
        F.min("source").alias("source"), F.min("doc_id").alias("doc_id"),
    )
    tie = F.xxhash64("ga", "gb")
    low = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(1 << 37))
    values = {"c_size": F.least("size", F.lit(1 << 37)), "c_lang": named("lang"), "c_source": named("source"), "c_id": low}
    return grouped.select("ga", "gb", "weight", *[_tied(v, tie).alias(c) for c, v in values.items()])


def _deal(heavy: list, shards: int, target: float) -> tuple[dict, list[float]]:
    """Heavy groups to the emptiest shard, largest first.  At most 64 groups per shard."""
    load, where = [0.0] * shards, {}
    for row in sorted(heavy, key=lambda r: (-r.weight, r.ga, r.gb)):
        shard = min(range(shards), key=lambda s: (load[s], s))
        where[row.ga, row.gb] = shard
        load[shard] += row.weight
    return where, [max(0.0, target - x) for x in load]


def _cut(rows: DataFrame, cuts: dict[int, tuple[str, float]]) -> dict[int, tuple[str, int]]:
    """For each node (coordinate, share of its weight that goes left) the first value that goes right.

    Two rounds of bucket sums: a million steps over the node's range.  What is collected is
    1,024 sums per node.
    """
    at = lambda c: F.coalesce(*[F.when(F.col("node") == n, F.col(x)) for n, (x, _) in cuts.items()]) if c is None else F.col(c)
    rows = rows.where(F.col("node").isin(*cuts)).select("node", "weight", at(None).alias("x"))
    span = {r.node: (r.low, r.high + 1, 0) for r in rows.groupBy("node").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    total = {r.node: r.w for r in rows.groupBy("node").agg(F.sum("weight").alias("w")).collect()}
    while any(high - low > 1 for low, high, _ in span.values()):
        edges = F.coalesce(*[
            F.when((F.col("node") == n) & (F.col("x") >= low) & (F.col("x") < high),
                   F.floor((F.col("x") - low) / F.lit(max(1, -(-(high - low) // _BUCKETS)))))
            for n, (low, high, _) in span.items()
        ])
        sums: dict[int, dict[int, int]] = {}
        for r in rows.withColumn("bucket", edges).where("bucket is not null").groupBy("node", "bucket").agg(F.sum("weight").alias("w")).collect():
            sums.setdefault(r.node, {})[r.bucket] = r.w
        narrowed = {}
        for n, (low, high, before) in span.items():
            width, goal, bucket = max(1, -(-(high - low) // _BUCKETS)), cuts[n][1] * total[n], -1
            for bucket in sorted(sums.get(n, {})):
                if before + sums[n][bucket] > goal:
                    break
                before += sums[n][bucket]
            else:
                bucket += 1
            start = low + bucket * width
            narrowed[n] = (start, min(high, start + width), before) if high - low > 1 and start < high else (start, start, before)
        span = {n: s for n, s in narrowed.items()}
        if all(high - low <= 1 for low, high, _ in span.values()):
            break
    return {n: (cuts[n][0], low) for n, (low, _, _) in span.items()}


def _leaves(groups: DataFrame, capacity: list[float]) -> DataFrame:
    """(ga, gb, shard): cut until every node is one shard."""
    whole = groups.agg(*[(F.max(c) - F.min(c)).alias(c) for c in COORDINATES]).first()
    spans = {0: (0, len(capacity))}
    groups = groups.withColumn("node", F.lit(0))
    rules: list[tuple[int, str, int, int, int]] = []
    while any(high - low > 1 for low, high in spans.values()):
        wide = [n for n, (low, high) in spans.items() if high - low > 1]
        ranges = groups.where(F.col("node").isin(*wide)).groupBy("node").agg(*[(F.max(c) - F.min(c)).alias(c) for c in COORDINATES]).collect()
        cuts, halves = {}, {}
        for r in ranges:
            low, high = spans[r.node]
            middle = (low + high) // 2
            widest = max(COORDINATES, key=lambda c: (r[c] / max(1, whole[c] or 0), -COORDINATES.index(c)))
            left, all_of = sum(capacity[low:middle]), sum(capacity[low:high])
            cuts[r.node] = (widest, left / all_of if all_of else 0.5)
            halves[r.node] = (low, middle, high)
        if not cuts:
            break
        moved = F.col("node")
        for n, (c, value) in _cut(groups, cuts).items():
            low, middle, high = halves[n]
            new = max(spans) + 1
            spans[new], spans[new + 1] = (low, middle), (middle, high)
            del spans[n]
            moved = F.when(F.col("node") == n, F.when(F.col(c) < value, F.lit(new)).otherwise(F.lit(new + 1))).otherwise(moved)
        for n in [n for n in wide if n in spans]:  # a node without rows
            spans[n] = (spans[n][0], spans[n][0] + 1)
        groups = groups.withColumn("node", moved)
    shard = F.coalesce(*[F.when(F.col("node") == n, F.lit(low)) for n, (low, _) in spans.items()])
    return groups.select("ga", "gb", shard.alias("shard"))


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Put documents into ``shards`` shards of nearly equal bytes; equal texts stay together.

    ``docs``: doc_id, text, lang, source.  Returns doc_id, size (UTF-8 bytes and 1; null text:
    1), text_crc32 (null text: of no bytes), shard, slot (gapless from 0 in each shard, by
    slices of the rows, then doc_id).  An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("ga"), F.col("text").isNull().alias("none"),
    )
    rows = rows.withColumn("gb", F.shiftleft(F.col("text_crc32"), 31) + F.when(F.col("none"), -1).otherwise(F.pmod("size", F.lit(1 << 31)))).drop("none")
    rows = stage(rows, "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    target = total / shards
    groups = stage(_groups(rows), "shard-groups")
    if not groups.where(F.col("weight") > target).isEmpty():
        # A group that no shard can hold is cut: its rows count as groups of their own.
        giants = groups.where(F.col("weight") > target).select("ga", "gb", F.lit(True).alias("giant"))
        own = F.xxhash64("ga", "gb", "doc_id")
        rows = stage(rows.join(F.broadcast(giants), ["ga", "gb"], "left").withColumn("ga", F.when(F.col("giant"), own).otherwise(F.col("ga"))).drop("giant"), "shard-rows")
        groups = stage(_groups(rows), "shard-groups")
    # At most 64 groups per shard weigh more than 1/64 of its target.
    heavy = groups.where(F.col("weight") > target / 64).select("ga", "gb", "weight").collect()
    where, capacity = _deal(heavy, shards, target)
    light = groups.where(F.col("weight") <= target / 64)
    placed = _leaves(light, capacity)
    if where:
        fixed = docs.sparkSession.createDataFrame([(*k, s) for k, s in where.items()], "ga long, gb long, shard int")
        placed = placed.unionByName(fixed)
    rows = rows.join(stage(placed, "shard-leaves"), ["ga", "gb"]).select("doc_id", "size", "text_crc32", "shard")
    return number(stage(rows, "shard-placed"), total)


def number(rows: DataFrame, total: int) -> DataFrame:
    """Gapless slots: rows are hashed into slices of some thousand rows; a slice's first slot
    comes from the counts of the slices before it, the place within from a window over the slice."""
    slices = max(16, rows.count() // _SLOT_ROWS)
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slices)))
    counts = rows.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")) - 1
    numbered = rows.withColumn("within", within).join(counts, ["shard", "slice"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"))

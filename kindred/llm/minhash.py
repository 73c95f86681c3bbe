"""Near-duplicates by fast similarity sketches, banding and exact verification.

Sketch: every element of a document's shingle set is hashed in rounds.  In the first
``size`` rounds it falls into a random bin, in the next ``size`` rounds all elements fall
into one bin per round, so every coordinate is filled after at most 2 * size rounds; a
coordinate keeps its smallest (round, hash).  Two sets agree in a coordinate with
probability equal to their Jaccard similarity, with the concentration of independent draws.

Candidates: documents that agree in all rows of a band.  Each bucket is tied to its
smallest document (a star, linear in the bucket), and the stars' connected components are
the *communities*: no pair of documents that shares a bucket lies in two of them.

Verification: the pairs of a community are compared on full sets, first each document
with a few pivots of its community.  What the pivots leave unconnected is compared in tiles
of bounded size; tiles emit only edges that connect something, never all pairs.

With 25 bands of 5 rows a pair of similarity 0.85 shares no band with probability 4e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.components import components
from kindred.llm.hashing import SPACED, batch_words, mix, shingles
from kindred.sources.staging import release, stage

SKETCH = 128
BANDS, ROWS = 25, 5
PIVOTS = 4
#: The map of the texts wanted has at most 2 to the power of so many bits.
MAP_BITS = 28
#: So many nodes of a community meet its pivots in one part.
PART = 512
TILE = 384
TILE_BYTES = 24 << 20
_ROUND_BITS = 10


def sketch(elements: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """The ``size`` coordinates (a power of two) of a non-empty set of distinct hashes."""
    one = np.uint64
    bits = size.bit_length() - 1
    low = one(64 - bits)
    found = np.zeros(size, dtype=np.uint64)
    filled = np.zeros(size, dtype=bool)
    start = 0
    while not filled.all():
        many = 1 if len(elements) >= 2 * size else max(1, (3 * size) // len(elements))
        rounds = np.arange(start, min(start + many, 2 * size), dtype=np.uint64)[:, None]
        hashed = mix(elements[None, :] ^ mix(rounds + one(1)))
        bins = np.where(rounds < one(size), hashed & one(size - 1), rounds % one(size))
        packed = (bins << low) | (rounds << one(64 - bits - _ROUND_BITS)) | (hashed >> one(bits + _ROUND_BITS))
        packed = np.sort(packed, axis=None)
        bins = (packed >> low).astype(np.intp)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        new = first[~filled[bins[first]]]
        found[bins[new]] = packed[new]
        filled[bins[new]] = True
        start += len(rounds)
    return found


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(bands, dtype=np.uint64) + np.uint64(rows)
    for column in coordinates[: bands * rows].reshape(bands, rows).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys


def _set_key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits of order-free digest of a set."""
    if not len(elements):
        return 0, 0
    return tuple(int(mix(elements ^ np.uint64(salt)).sum().view(np.int64)) for salt in (0x51ED270B, 0x7F4A7C15))


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_a, set_b, bands) for each row of docs."""
    schema = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, banded = [], [], []
            for hashes in batch_words(batch.column("text").to_pylist(), SPACED):
                elements = shingles(hashes, words)
                counts.append(len(elements))
                keys.append(_set_key(elements))
                banded.append(band_keys(sketch(elements), bands, rows).view(np.int64) if counts[-1] else [])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.int64()),
                pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()),
                pa.array(banded, pa.list_(pa.int64())),
            ], ["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "bands"])

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows_in.mapInArrow(run, schema)


def _full_sets(texts: DataFrame, words: int) -> DataFrame:
    """The columns of a candidate and ``members``: the sorted hashes of its text's shingles as bytes."""
    kept = ["node", "n", "community", "pivot", "parts", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x, words).tobytes() for x in batch_words(batch.column("text").to_pylist(), SPACED)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sets, pa.binary())], [*kept, "members"])

    schema = "node long, n long, community long, pivot boolean, parts int, part int, members binary"
    return texts.select(*kept, "text").mapInArrow(run, schema)


def _alike(a: int, b: int, shared: int | np.ndarray, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def _verify(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the rows (a, b, set_a, set_b) whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                one, two = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.sort(np.concatenate((one, two)))
                keep.append(bool(_alike(len(one), len(two), int((both[1:] == both[:-1]).sum()), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def tile_edges(nodes: np.ndarray, labels: np.ndarray, left: np.ndarray, sets: list[np.ndarray], percent: int):
    """Edges that connect what ``labels`` leaves apart, between the rows marked in ``left``
    and all rows (among all, if everything is marked).  A row's set is tested against all
    others at once: its elements are flagged and the flags are summed set by set."""
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum([len(s) for s in sets])
    starts = np.concatenate(([0], ends[:-1]))
    sizes = ends - starts
    root = np.unique(labels, return_inverse=True)[1]
    flags = np.zeros(int(ids.max()) + 1, dtype=np.int64)
    edges = []
    for x in np.flatnonzero(left):
        apart = root != root[x]
        if not apart.any():
            continue
        own = ids[starts[x]: ends[x]]
        flags[own] = 1
        shared = np.add.reduceat(flags[ids], starts)
        flags[own] = 0
        for y in np.flatnonzero(_alike(sizes[x], sizes, shared, percent) & apart):
            if root[y] != root[x]:
                root[root == root[y]] = root[x]
                edges.append((int(nodes[x]), int(nodes[y])))
    return edges


def _tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges between different labels inside each community.

    ``members``: node, n, community, label; ``sets``: node, members.  A community is cut into parts of
    bounded bytes, its largest label (``main``) apart from the rest, by hashes of the node.  A tile is a
    pair of parts of which one at least is of the rest: two parts of one label need no comparison.
    Sets are sent for communities of several labels only, spread by tile.
    """
    sized = stage(members.groupBy("community", "label").agg(
        F.count("*").alias("rows"), F.sum("n").alias("total")
    ), "label-sizes")
    # The most rows, then the smallest label.
    biggest = F.max(F.struct("rows", F.bitwise_not("label").alias("label")))
    main = sized.groupBy("community").agg(biggest.alias("main"), F.sum("rows").alias("all_rows"), F.sum("total").alias("all_total"))
    # More rows than the largest label has: another label is there.
    main = main.where("all_rows > main.rows").withColumn("main_label", F.bitwise_not("main.label"))
    own = sized.select("community", F.col("label").alias("main_label"), F.col("total").alias("main_total"))
    count = lambda rows, total: F.greatest(F.ceil(rows / TILE), F.ceil(total * 8 / TILE_BYTES)).cast("int")
    plan = stage(main.join(own, ["community", "main_label"]).select(
        "community", "main_label", count(F.col("main.rows"), F.col("main_total")).alias("main_parts"),
        count(F.col("all_rows") - F.col("main.rows"), F.col("all_total") - F.col("main_total")).alias("rest_parts"),
    ), "tile-plan")
    spread = F.xxhash64("node", F.lit("part"))
    own = F.when(F.col("in_main"), F.pmod(spread, "main_parts")).otherwise(F.pmod(spread, "rest_parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("rest_parts") - 1)
    mine = F.when(F.col("in_main"), F.transform(others, lambda r: F.struct(r.alias("r"), F.col("part").alias("c"), F.lit(True).alias("m")))) \
        .otherwise(F.concat(
            F.transform(others, lambda r: F.struct(F.least(r, "part").alias("r"), F.greatest(r, "part").alias("c"), F.lit(False).alias("m"))),
            F.transform(F.sequence(F.lit(0), F.col("main_parts") - 1), lambda c: F.struct(F.col("part").alias("r"), c.alias("c"), F.lit(True).alias("m"))),
        ))
    rows = stage(members.join(plan, "community").withColumn("in_main", F.col("label") == F.col("main_label")), "tiled")
    rows = sets.join(rows.withColumn("part", own).drop("n"), "node").withColumn("tile", F.explode(mine))
    rows = rows.select("community", "tile.r", "tile.c", "tile.m", "part", "in_main", "node", "label", "members")
    # The joins leave rows dealt by community or node; a community's tiles belong to as many tasks as there are.
    rows = rows.repartition("community", "r", "c", "m")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        nodes, labels = (table.column(c).to_numpy() for c in ("node", "label"))
        sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for chunk in table.column("members").chunks for v in chunk]
        rest = ~table.column("in_main").to_numpy(zero_copy_only=False)
        if not key[3].as_py():
            rest &= table.column("part").to_numpy() == key[1].as_py()
        edges = tile_edges(nodes, labels, rest, sets, percent) if rest.any() else []
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return rows.groupBy("community", "r", "c", "m").applyInArrow(run, "a long, b long")


def _perhaps(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose text_hash may be among those of ``wanted``: all that are, and few others.

    The hashes wanted mark one bit each of a map, eight bits for each hash but at most 2 ** MAP_BITS (32 MB)
    in all, which is broadcast in pieces of 4 KB: texts that are not wanted stay out of the
    shuffle.  A full map would let every row pass.
    """
    bits = min(MAP_BITS, max(20, (8 * wanted.count()).bit_length()))
    spot = F.pmod("text_hash", F.lit(1 << bits))
    marked = wanted.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("map")
    )
    spots = texts.withColumn("bucket", F.bitmap_bucket_number(spot)).withColumn("at", F.bitmap_bit_position(spot))
    byte = F.conv(F.hex(F.substring("map", (F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.get(F.array(*[byte.bitwiseAND(F.lit(1 << i)) for i in range(8)]), (F.col("at") % 8).cast("int")) != 0
    return spots.join(F.broadcast(marked), "bucket").where(hit).select(*texts.columns)


def _with_pivots(wanted: DataFrame) -> DataFrame:
    """Mark the pivots of each community, the smallest node and a few others, chosen by hash, and deal the
    community into parts: ``pivot``, ``parts``, ``part``.  Linear in the community."""
    chosen = wanted.groupBy("community").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"), F.min("node").alias("p0"), *[
        F.min_by("node", F.xxhash64("node", F.lit(i))).alias(f"p{i}") for i in range(1, PIVOTS)
    ])
    chosen = chosen.select("community", "parts", F.array(*[f"p{i}" for i in range(PIVOTS)]).alias("chosen"))
    return wanted.join(chosen, "community").select(
        "node", "text_hash", "n", "community", F.array_contains("chosen", F.col("node")).alias("pivot"), "parts",
        F.pmod(F.xxhash64("node", F.lit("pivot")), "parts").cast("int").alias("part"),
    )


def _pivot_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, set_a, set_b) for the pivots a of each community and its other nodes b of a fitting size.

    Every set is sent once, to its part of the community; the pivots are repeated for each part.
    """
    pivots = sets.where("pivot").select(
        "community", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("members").alias("set_a"),
    )
    others = sets.select("community", "part", F.col("node").alias("b"), "n", F.col("pivot").alias("also"), F.col("members").alias("set_b"))
    close = 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
    apart = F.when(F.col("also"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    return others.join(pivots, ["community", "part"]).where(apart & close).select("a", "b", "set_a", "set_b")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Link documents whose shingle sets have 100 * intersection >= percent * union.

    Returns doc_id, text_hash, n_shingles, component_id (the smallest doc_id reachable) and
    kept, one row per row of ``docs`` (columns doc_id, text; others are ignored).  Words are
    runs of anything but ASCII white space, A-Z lower-cased; a text with fewer than ``words``
    words is one shingle.  Null and blank texts have no shingles and link with nothing.  Rows
    with equal sets are linked and compared once.  Rows that share a doc_id are one vertex.
    A row with a null doc_id takes no part: component null, kept.
    """
    signed = stage(signatures(docs, words, bands, rows), "signatures")
    # One representative of each set: later steps see every set once.
    able = signed.where("n_shingles > 0 and doc_id is not null")
    classes = able.groupBy("set_a", "set_b").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    classes = stage(classes.select("set_a", "set_b", F.col("first.doc_id").alias("node"), F.col("first.text_hash").alias("text_hash"), "n", "bands"), "classes")
    banded = classes.select(F.explode("bands").alias("bucket"), "node")
    stars = stage(banded.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "stars")
    star_edges = banded.join(stars, "bucket").where("a < node").select("a", F.col("node").alias("b"))
    communities = stage(components(star_edges).withColumnRenamed("component", "community"), "communities")
    release(stars)
    wanted = stage(classes.join(communities, "node").select("node", "text_hash", "n", "community"), "candidates")
    wanted = stage(_with_pivots(wanted), "candidates")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.xxhash64("text").alias("text_hash"), "text")
    found = wanted.join(_perhaps(texts, wanted), ["node", "text_hash"]).dropDuplicates(["node", "text_hash"])
    sets = stage(_full_sets(found, words), "sets")
    edges = stage(_verify(_pivot_pairs(sets, percent), percent), "edges")
    labels = stage(components(edges), "labels")

    # The rest: communities in which more than one component is left.
    members = wanted.join(labels, "node", "left").select(
        "node", "n", "community", F.coalesce("component", "node").alias("label")
    )
    edges = edges.unionByName(stage(_tiles(stage(members, "members"), sets.select("node", "members"), percent), "edges"))
    release(sets)
    # Rows to representatives; a doc_id with several texts ties their representatives.
    rows_of = able.join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
    rows_of = stage(rows_of.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("last")), "rows")
    edges = edges.unionByName(_ties(able, classes, rows_of))
    labels = stage(components(edges), "labels")
    found = rows_of.join(labels, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    out = signed.select("doc_id", "text_hash", "n_shingles").join(found, "doc_id", "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _ties(able: DataFrame, classes: DataFrame, rows_of: DataFrame) -> DataFrame:
    """Edges between the representatives of one doc_id's texts, where it has several."""
    several = rows_of.where("node < last").select("doc_id", F.col("node").alias("a"))
    texts = able.join(several, "doc_id").join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
    return texts.select("a", F.col("node").alias("b")).where("a <> b").distinct()

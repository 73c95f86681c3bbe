"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors of cosine c have the squared distance 2 - 2c.  Rotated and split into
blocks of dimensions, that distance is the sum over the blocks, so in one block at least it
is within the block's share of the budget (in proportion to its dimensions).  Each block is joined by range: a grid
over its first few coordinates; a vector lives in its home cell and visits those cells
before it (in cell order) that its ball of the block's radius touches, so two vectors within
the budget meet in exactly one cell, the home of one of them.

A cell's pairs are tested against the block's budget, pairs that an earlier block finds are left to it,
and what remains is verified exactly: the cosine of the original components in double
precision.  Cells are cut into tiles of bounded size.  A tile returns, for each vector, how many it is
linked with and one vector of its connected part: never a pair of links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.ann import usable
from kindred.llm.components import components
from kindred.sources.staging import stage

BLOCK_DIMENSIONS = 8
GRID = 3
#: Width of a grid cell in radii of the block.
WIDTH = 2.5
TILE = 1500
BATCH_ROWS = 500
_PAIRS = 1 << 16
_SLACK = 1e-9


@lru_cache(maxsize=4)
def _rotation(dimensions: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(5).normal(size=(dimensions, dimensions)))[0]


def blocks_of(dimensions: int) -> list[slice]:
    cuts = np.linspace(0, dimensions, max(1, dimensions // BLOCK_DIMENSIONS) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def rotated(rows: np.ndarray) -> np.ndarray:
    """Unit vectors in the rotated space."""
    return (rows / np.sqrt((rows * rows).sum(axis=1))[:, None]) @ _rotation(rows.shape[1])


def _budget(block: slice, dimensions: int, cosine: float) -> float:
    return (2 - 2 * cosine + _SLACK) * (block.stop - block.start) / dimensions


def _code(cells: np.ndarray) -> np.ndarray:
    """One long per cell, in lexicographic order."""
    code = np.zeros(len(cells), np.int64)
    for column in cells.T:
        code = code * (1 << 20) + (column + (1 << 19))
    return code


def memberships(rows: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: row numbers, cells, and whether the cell is the row's home."""
    unit = rotated(rows)
    for number, block in enumerate(blocks_of(rows.shape[1])):
        radius = np.sqrt(_budget(block, rows.shape[1], cosine)) * (1 + _SLACK)
        width = WIDTH * radius
        x = unit[:, block][:, :GRID]
        home = np.floor(x / width).astype(np.int64)
        low, high = np.floor((x - radius) / width).astype(np.int64), np.floor((x + radius) / width).astype(np.int64)
        own = _code(home)
        yield number, np.arange(len(rows)), own, np.ones(len(rows), bool)
        for steps in np.ndindex(*[int(n) for n in (high - low).max(axis=0) + 1]):
            cell = low + np.array(steps)
            code = _code(cell)
            visits = np.flatnonzero((cell <= high).all(axis=1) & (code < own))
            yield number, visits, code[visits], np.zeros(len(visits), bool)


def tile_links(rows: np.ndarray, home: np.ndarray, part: np.ndarray, parts: tuple[int, int], number: int, cosine: float):
    """Pairs (i, j) of a tile that are linked and found first in block ``number``.

    One of a pair is in part ``parts[0]``, the other in ``parts[1]``; one at least is at home.
    """
    unit = rotated(rows)
    spans = blocks_of(rows.shape[1])
    budgets = [_budget(b, rows.shape[1], cosine) for b in spans]
    norms = np.sqrt((rows * rows).sum(axis=1))
    left, right = np.flatnonzero(part == parts[0]), np.flatnonzero(part == parts[1])
    x = unit[:, spans[number]]
    squares = (x * x).sum(axis=1)
    stripe = max(1, (1 << 20) // max(1, len(right)))
    for start in range(0, len(left), stripe):
        a = left[start: start + stripe]
        near = squares[a][:, None] + squares[right][None, :] - 2 * (x[a] @ x[right].T) <= budgets[number] + _SLACK
        near &= home[a][:, None] | home[right][None, :]
        if parts[0] == parts[1]:
            near &= a[:, None] < right[None, :]
        first, second = np.nonzero(near)
        for cut in range(0, len(first), _PAIRS):
            i, j = a[first[cut: cut + _PAIRS]], right[second[cut: cut + _PAIRS]]
            apart = unit[i] - unit[j]
            apart *= apart
            fresh = apart[:, spans[number]].sum(axis=1) <= budgets[number]
            for earlier in range(number):
                fresh &= apart[:, spans[earlier]].sum(axis=1) > budgets[earlier]
            i, j = i[fresh], j[fresh]
            same = (rows[i] * rows[j]).sum(axis=1) / (norms[i] * norms[j]) >= cosine
            yield i[same], j[same]


def _roots(count: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row that each row reaches over the pairs."""
    root = np.arange(count)
    i = np.concatenate([p[0] for p in pairs])
    j = np.concatenate([p[1] for p in pairs])
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _cells(classes: DataFrame, cosine: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                sizes = part.column(2).to_numpy()
                for d in np.unique(sizes):
                    mine = part.filter(pa.array(sizes == d))
                    nodes, labels = mine.column(0).to_numpy(), mine.column(1).to_numpy()
                    for number, rows, cells, home in memberships(_matrix(mine.column(3)), cosine):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(rows), d, np.int32)), pa.array(labels[rows]), pa.array(np.full(len(rows), number, np.int32)),
                            pa.array(cells), pa.array(home), pa.array(nodes[rows]),
                        ], ["d", "label", "block", "cell", "home", "node"])

    return classes.select("node", "label", "d", "embedding").mapInArrow(run, "d int, label long, block int, cell long, home boolean, node long")


def _tiles(classes: DataFrame, cosine: float) -> DataFrame:
    """(node, links, root) for the nodes that a tile links; links counts rows."""
    cell = ["d", "label", "block", "cell"]
    members = stage(_cells(classes, cosine), "cells")
    counts = members.groupBy(*cell).agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("at_home"))
    counts = stage(counts.where("n > 1 and at_home > 0").select(*cell, F.ceil(F.col("n") / TILE).cast("int").alias("parts")), "cell-sizes")
    placed = members.join(counts, cell).withColumn("part", F.pmod(F.xxhash64("node", "cell"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.select(*cell, F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "home", "node")
    placed = placed.join(classes.select("node", "weight", "embedding"), "node")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows, nodes, weights = _matrix(table.column("embedding")), table.column("node").to_numpy(), table.column("weight").to_numpy()
        home, part = table.column("home").to_numpy(zero_copy_only=False), table.column("part").to_numpy()
        pairs = [p for p in tile_links(rows, home, part, (key[4].as_py(), key[5].as_py()), key[2].as_py(), cosine) if len(p[0])]
        found = np.empty(0, np.intp)
        links = root = np.zeros(len(rows), np.int64)
        if pairs:
            links = sum(np.bincount(i, weights[j], len(rows)) + np.bincount(j, weights[i], len(rows)) for i, j in pairs).astype(np.int64)
            root, found = _roots(len(rows), pairs), np.flatnonzero(links)
        return pa.table({"node": nodes[found], "links": links[found], "root": nodes[root[found]]})

    placed = placed.select(*cell, "a", "b", "part", "home", "node", "weight", "embedding")
    return placed.groupBy(*cell, "a", "b").applyInArrow(run, "node long, links long, root long")


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Link rows of equal label whose cosine is at least ``cosine``.

    ``vectors``: vec_id, embedding, label.  Returns, one row per row, vec_id, n_links (other rows linked
    directly), component_id (smallest vec_id reachable, itself included) and kept.  Rows with a null
    label, or a vector that is null, zero, or holds null or non-finite components, link with nothing; nor do vectors
    of different lengths.  Equal vectors are handled once.  Rows that share a vec_id are one
    vertex for components.  A null vec_id takes no part: component null, kept.
    """
    vector = F.col("embedding")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("embedding"),
    )
    able = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(vector), F.lit(False))
    rows = rows.withColumn("able", able)
    classes = rows.where("able").groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("node"), "label", F.size("embedding").alias("d"), "embedding", "weight", "first"), "classes")
    tiles = stage(_tiles(classes, cosine), "links")
    links = tiles.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = stage(rows.where("able").join(classes.drop("first", "d"), ["label", "embedding"]).select("vec_id", "node", "weight"), "rows")
    several = nodes.groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last")
    ties = nodes.join(several, "vec_id").select("a", F.col("node").alias("b")).where("a < b")
    edges = tiles.select(F.col("root").alias("a"), F.col("node").alias("b")).where("a <> b").unionByName(ties)
    labels = stage(components(edges), "labels")
    named = classes.join(labels, "node").groupBy("component").agg(F.min("first").alias("smallest"))
    named = stage(labels.join(named, "component").select("node", "smallest"), "names")
    per_node = classes.select("node", "first").join(links, "node", "left").join(named, "node", "left")
    per_node = stage(per_node.select("node", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("smallest", "first").alias("component_id")), "nodes")
    linked = nodes.join(per_node, "node").select("vec_id", (F.col("links") + F.col("weight") - 1).cast("long").alias("n_links"), "component_id")
    alone = rows.where(~F.col("able")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

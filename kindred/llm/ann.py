"""Approximate nearest neighbours by collision counting.

Vectors of unit length are projected on a fixed orthonormal basis.  An index block holds, for
each projection, the block's vectors in the order of their projections: sorted arrays, one
per projection, that serve every radius.  A query opens a window around its own projection in
each array; a vector collides where it lies in the window.  Virtual rehashing widens all
windows by a factor until at least PROBE of the block's different ids exceed the collision
threshold; each widening counts only what the windows gain.  All vectors over the threshold
are verified: their cosine is computed on the original components in double precision.

All rows are indexed, in blocks of bounded size.  Queries are cut into blocks, too; every
block of queries meets every block of vectors, and only the best few of each query leave
the pair of blocks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.sources.staging import stage

BLOCK = 8192
QUERIES = 512
PROBE = 0.06
#: Window radii as shares of a random unit vector's standard projection 1 / sqrt(d).
RADII = (*(1.1 * 1.07**i for i in range(12)), 3.2, 5.0, 8.0, np.inf)
THRESHOLD = 0.8


@lru_cache(maxsize=4)
def basis(dimensions: int, seed: int = 11) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, dimensions)))[0]


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def cosines(query: np.ndarray, rows: np.ndarray, query_norm: float, norms: np.ndarray) -> np.ndarray:
    """dot / (norm * norm), each row summed in the same order, so that equal rows get equal values."""
    return (rows * query).sum(axis=1) / (query_norm * norms)


class Block:
    """The sorted arrays of one block of vectors (float64 rows) and their ids."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.different = len(np.unique(ids))
        self.norms = np.sqrt((rows * rows).sum(axis=1))
        projected = (rows / self.norms[:, None]) @ basis(rows.shape[1])
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(projected.T, self.order, axis=1)

    def candidates(self, queries: np.ndarray) -> list[np.ndarray]:
        """For each query (unit length) the rows whose collisions exceed the threshold."""
        count, dimensions = self.rows.shape
        wanted = min(self.different, max(16, int(PROBE * self.different)))
        projected = queries @ basis(dimensions)
        needed = int(np.ceil(THRESHOLD * dimensions))
        scale = 1 / np.sqrt(dimensions)
        bounds = []
        for radius in RADII:
            low, high = np.empty((dimensions, len(queries)), np.intp), np.empty((dimensions, len(queries)), np.intp)
            for i in range(dimensions):
                low[i] = np.searchsorted(self.sorted[i], projected[:, i] - radius * scale, "left")
                high[i] = np.searchsorted(self.sorted[i], projected[:, i] + radius * scale, "right")
            bounds.append((low.T, high.T))
        found = []
        for q in range(len(queries)):
            counts = np.zeros(count, np.int32)
            seen_low = seen_high = None
            for low, high in bounds:
                gained = []
                for i in range(dimensions):
                    a, b = low[q, i], high[q, i]
                    if seen_low is None:
                        gained.append(self.order[i, a:b])
                    else:
                        gained += [self.order[i, a: seen_low[i]], self.order[i, seen_high[i]: b]]
                counts += np.bincount(np.concatenate(gained), minlength=count)
                seen_low, seen_high = low[q], high[q]
                over = np.flatnonzero(counts >= needed)
                # Repeated rows of an id are one candidate.
                if len(over) >= wanted and (self.different == count or len(np.unique(self.ids[over])) >= wanted):
                    break
            found.append(over)
        return found


def best(block: Block, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """The k nearest of the block for each query: (query_id, vec_id, score)."""
    norms = np.sqrt((queries * queries).sum(axis=1))
    ids, out = block.ids, ([], [], [])
    for q, over in enumerate(block.candidates(queries / norms[:, None])):
        over = over[ids[over] != query_ids[q]]
        scores = cosines(queries[q], block.rows[over], norms[q], block.norms[over])
        order = np.lexsort((ids[over], -scores))
        # Repeated rows of an id count once, before the best k are taken.
        first = order[np.sort(np.unique(ids[over[order]], return_index=True)[1])[:k]]
        out[0].extend([int(query_ids[q])] * len(first))
        out[1].extend(ids[over[first]].tolist())
        out[2].extend(scores[first].tolist())
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The k nearest rows by cosine of every query row, found approximately, scored exactly.

    ``vectors``: vec_id, embedding.  Returns query_id, rank (from 1), vec_id, score; ties go to the smaller
    vec_id.  Rows that are not usable (null or zero vector, null or non-finite component) or
    have a null vec_id take no part.  Only vectors of equal length are compared.  Rows of
    the query's own vec_id are not its neighbours; repeated rows of an id count once.
    """
    vector = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda x: x.cast("double")).alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(vector)).withColumn("d", F.size(vector))
    rows = stage(rows.withColumn("query", F.coalesce(is_query, F.lit(False))), "vectors")
    totals = rows.agg(F.count("*"), F.sum(F.col("query").cast("long"))).first()
    blocks, parts = max(1, -(-totals[0] // BLOCK)), max(1, -(-(totals[1] or 0) // QUERIES))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select("d", spread(blocks, "block").alias("block"), every(parts).alias("part"), F.lit(False).alias("query"), "vec_id", "embedding")
    asked = rows.where("query").select("d", every(blocks).alias("block"), spread(parts, "part").alias("part"), "query", "vec_id", "embedding")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        asks = table.column("query").to_numpy(zero_copy_only=False)
        data, ids = _matrix(table.column("embedding")), table.column("vec_id").to_numpy()
        if asks.all() or not asks.any():
            columns = ([], [], [])
        else:
            columns = best(Block(data[~asks], ids[~asks]), data[asks], ids[asks], k)
        types = (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
        return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, types)})

    found = held.unionByName(asked).groupBy("d", "block", "part").applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

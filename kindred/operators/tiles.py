"""Blocks of the user x user similarity table for users of hot items.

A pair's similarity is a sum over shared items, and items are divided by their popularity.  What a pair
shares of *light* items comes out of an item join, summed to one row per pair.  Only ratings on *hot*
items are replicated: users are hashed into blocks, a tile is a pair of blocks and one Spark
group, and a hot rating is sent to as many tiles as there are blocks.  Both halves meet in a cogroup per tile,
so the shuffle grows with hot ratings x blocks plus the pairs of light items, never with the square of
an item's popularity, and the size of a tile is fixed by the settings whatever the data.  Inside a tile numpy adds
up the products item by item, or for many small items at once, and then the light sums; a tile returns its top k, its
partial sums or its statistics, and pairs only where pairs are the result.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.schema import SIMILARITY_PLACES, FitSettings

# Ship the functions below with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIR_SCHEMA = "user_id bigint, neighbor_id bigint, similarity double"
SUM_SCHEMA = "user_id bigint, item_id bigint, num double, den double"
STATS_SCHEMA = (
    "shared bigint, nonzero bigint, total double, squares double, low double, high double"
)

# An item with this many pairs in a tile is added as one block; smaller ones are
# added together, so many pairs at a time.
BLOCK_PAIRS = 1_024
BATCH_PAIRS = 2_000_000


def block_count(rows: DataFrame, settings: FitSettings) -> Column:
    """Blocks that bound both the users and the hot ratings of one, as a scalar."""
    sizing = rows.where("tiled and hot").agg(
        F.ceil(F.greatest(
            F.lit(1.0),
            F.approx_count_distinct("user_id") / F.lit(settings.tile_users),
            F.count(F.lit(1)) / F.lit(settings.tile_ratings),
        )).cast("int")
    )
    return sizing.scalar()


def in_block(user: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(user), blocks).cast("int")


def heavy_rows(rows: DataFrame, settings: FitSettings, wanted: DataFrame | None = None) -> DataFrame:
    """Ratings of tiled users on hot items (and wanted cells of such users and items) with the user's block."""
    cells = rows.where("tiled and hot").select(
        "user_id", "item_id", "weight", "dev", "n_rated", F.lit(False).alias("wanted")
    )
    if wanted is not None:
        cells = cells.unionByName(wanted.where("tiled and hot").select(
            "user_id", "item_id",
            F.lit(0.0).alias("weight"), F.lit(0.0).alias("dev"),
            F.lit(0).cast("bigint").alias("n_rated"), F.lit(True).alias("wanted"),
        ))
    blocks = F.col("blocks")
    return cells.withColumn("blocks", block_count(rows, settings)).withColumn("block", in_block("user_id", blocks))


def to_tiles(cells: DataFrame, others: Column) -> DataFrame:
    """Each cell once for each of the ``others`` (an array of blocks) that its block is paired with."""
    return cells.withColumn("other", F.explode(others)).select(
        F.least("block", "other").alias("tile_i"), F.greatest("block", "other").alias("tile_j"),
        "block", "user_id", "item_id", "weight", "dev", "n_rated", "wanted",
    )


def tiled_rows(rows: DataFrame, settings: FitSettings, wanted: DataFrame | None = None) -> DataFrame:
    """Heavy rows, once per tile of their block."""
    return to_tiles(heavy_rows(rows, settings, wanted), F.sequence(F.lit(0), F.col("blocks") - 1))


def light_sums(rows: DataFrame) -> DataFrame:
    """What two tiled users a < b share of light items: product and number of shared items."""
    light = rows.where("tiled and not hot")
    left = light.select("item_id", F.col("user_id").alias("a"), F.col("weight").alias("a_weight"))
    right = light.select("item_id", F.col("user_id").alias("b"), F.col("weight").alias("b_weight"))
    return left.join(right, "item_id").where("a < b").groupBy("a", "b").agg(
        F.sum(F.col("a_weight") * F.col("b_weight")).alias("value"), F.count(F.lit(1)).alias("shared")
    )


# What the light side of a tile holds: a pair's sum, or a rating to be weighted with the similarity of its pair for the
# first or for the second user of the pair.
SUM, FOR_FIRST, FOR_SECOND = 0, 1, 2


def light_tiles(pairs: DataFrame) -> DataFrame:
    """Rows (a, b, a_block, b_block, value, shared, kind, item_id) under the key of their tile; the first user of a row is in the
    tile's first block."""
    turned = F.col("a_block") > F.col("b_block")
    kind = F.when(turned & (F.col("kind") != SUM), FOR_FIRST + FOR_SECOND - F.col("kind")).otherwise(F.col("kind"))
    return pairs.select(
        F.least("a_block", "b_block").alias("tile_i"), F.greatest("a_block", "b_block").alias("tile_j"),
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("first"),
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("second"),
        kind.alias("kind"), "item_id", "value", "shared",
    )


def light_rows(rows: DataFrame, settings: FitSettings, terms: DataFrame | None = None) -> DataFrame:
    """The light side of all tiles: pair sums, and ``terms`` (a wants, b rated, item_id, value)."""
    sums = light_sums(rows).withColumn("kind", F.lit(SUM)).withColumn("item_id", F.lit(0).cast("bigint"))
    if terms is not None:
        sums = sums.unionByName(
            terms.withColumn("kind", F.lit(FOR_FIRST)).withColumn("shared", F.lit(0).cast("bigint"))
        )
    blocks = block_count(rows, settings)
    placed = sums.withColumn("blocks", blocks)
    for user in ("a", "b"):
        placed = placed.withColumn(f"{user}_block", in_block(user, F.col("blocks")))
    return light_tiles(placed)


def per_tile(heavy: DataFrame, light: DataFrame, emit, schema: str) -> DataFrame:
    """Run ``emit(heavy rows, light rows)`` for every tile that has either."""
    keys = ["tile_i", "tile_j"]
    return heavy.groupBy(*keys).cogroup(light.groupBy(*keys)).applyInPandas(emit, schema)


class Block:
    """Ratings of one block of users, sorted by item."""

    def __init__(self, ratings: pd.DataFrame):
        by_item = ratings.sort_values("item_id", kind="stable")
        self.users, self.row = np.unique(by_item["user_id"].to_numpy(), return_inverse=True)
        self.weight = by_item["weight"].to_numpy()
        self.dev = by_item["dev"].to_numpy()
        self.sizes = np.zeros(len(self.users))
        self.sizes[self.row] = by_item["n_rated"].to_numpy()
        self.items, first = np.unique(by_item["item_id"].to_numpy(), return_index=True)
        self.span = np.append(first, len(by_item))
        self.counts = np.diff(self.span)

    def raters(self, i: int) -> slice:
        return slice(self.span[i], self.span[i + 1])


def pairs_in_batches(left: Block, right: Block, i: np.ndarray, j: np.ndarray):
    """Positions (in left, in right) of all pairs of raters of the items i = j, in batches."""
    width = right.counts[j]
    ends = np.cumsum(left.counts[i] * width)
    start = 0
    while start < len(i):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + BATCH_PAIRS, side="right")))
        item = np.repeat(np.arange(start, stop), np.diff(ends[start:stop], prepend=done))
        at = np.arange(done, ends[stop - 1]) - (ends[item] - left.counts[i[item]] * width[item])
        yield left.span[i[item]] + at // width[item], right.span[j[item]] + at % width[item]
        start = stop


def places(light: pd.DataFrame, left: Block, right: Block):
    """Rows of the light side whose users are both in the tile, with their cells in its table."""
    found = []
    for users, column in ((left.users, "first"), (right.users, "second")):
        ids = light[column].to_numpy()
        at = np.searchsorted(users, ids)
        found.append((at, users[np.minimum(at, len(users) - 1)] == ids if len(users) else np.zeros(len(ids), bool)))
    inside = found[0][1] & found[1][1]
    return light[inside], found[0][0][inside], found[1][0][inside]


def similarity_table(left: Block, right: Block, metric: str, light: pd.DataFrame | None = None):
    """Similarity and co-rating mask of every user of ``left`` with every one of ``right``."""
    shape = (len(left.users), len(right.users))
    shared = np.zeros(shape, dtype=np.int32)
    dots = np.zeros(shape) if metric == "cosine" else None
    _, i, j = np.intersect1d(left.items, right.items, assume_unique=True, return_indices=True)
    large = left.counts[i] * right.counts[j] >= BLOCK_PAIRS
    for x, y in zip(i[large], j[large]):
        a, b = left.raters(x), right.raters(y)
        cells = np.ix_(left.row[a], right.row[b])
        # Indexed addition adds once per cell: right only if no user rated the item twice.
        once = len(np.unique(left.row[a])) == len(left.row[a]) and len(np.unique(right.row[b])) == len(right.row[b])
        products = np.multiply.outer(left.weight[a], right.weight[b])
        if once:
            shared[cells] += 1
            if dots is not None:
                dots[cells] += products
        else:
            np.add.at(shared, cells, 1)
            if dots is not None:
                np.add.at(dots, cells, products)
    for a, b in pairs_in_batches(left, right, i[~large], j[~large]):
        cells = left.row[a] * shape[1] + right.row[b]
        np.add.at(shared.reshape(-1), cells, 1)
        if dots is not None:
            np.add.at(dots.reshape(-1), cells, left.weight[a] * right.weight[b])
    if light is not None and len(light):
        sums, a, b = places(light[light["kind"] == SUM], left, right)
        for x, y in ((a, b), (b, a)) if left is right else ((a, b),):
            shared[x, y] += sums["shared"].to_numpy().astype(np.int32)
            if dots is not None:
                dots[x, y] += sums["value"].to_numpy()
    mask = shared > 0
    if metric == "cosine":
        table = dots
    elif metric == "overlap":
        table = shared.astype(float)
    else:
        union = left.sizes[:, None] + right.sizes[None, :] - shared
        table = np.divide(shared, union, out=np.zeros(shape), where=union > 0)
    unit = 10.0 ** SIMILARITY_PLACES  # the same steps as functions.rounded
    return np.floor(table * unit + 0.5) / unit, mask


def open_tile(rows: pd.DataFrame, light: pd.DataFrame, metric: str):
    """The two blocks of a tile, their similarity table, and whether they are one block."""
    i, j = int(rows["tile_i"].iat[0]), int(rows["tile_j"].iat[0])
    ratings = rows[~rows["wanted"]]
    left = Block(ratings[ratings["block"] == i])
    right = left if i == j else Block(ratings[ratings["block"] == j])
    table, mask = similarity_table(left, right, metric, light)
    if i == j:
        np.fill_diagonal(mask, False)
        np.fill_diagonal(table, 0.0)
    return left, right, table, mask, i == j


NO_PAIRS = pd.DataFrame({"user_id": [], "neighbor_id": [], "similarity": []})


def tile_pairs(rows: DataFrame, settings: FitSettings, metric: str) -> DataFrame:
    """Every co-rating pair of tiled users, user_id < neighbor_id."""

    def emit(heavy: pd.DataFrame, light: pd.DataFrame) -> pd.DataFrame:
        if heavy.empty:
            return NO_PAIRS
        left, right, table, mask, same = open_tile(heavy, light, metric)
        a, b = np.nonzero(np.triu(mask) if same else mask)
        u, v = left.users[a], right.users[b]
        return pd.DataFrame({
            "user_id": np.minimum(u, v), "neighbor_id": np.maximum(u, v), "similarity": table[a, b],
        })

    return per_tile(tiled_rows(rows, settings), light_rows(rows, settings), emit, PAIR_SCHEMA)


def best_of_rows(users, others, table, mask, k: int) -> pd.DataFrame:
    """Per row the k highest similarities, equal ones by smaller id."""
    score = np.where(mask, table, -np.inf)
    if k < score.shape[1]:
        least = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
        mask = mask & (score >= least)  # ties with the k-th are still in
    row, at = np.nonzero(mask)
    order = np.lexsort((others[at], -score[row, at], row))
    row, at = row[order], at[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    row, at = row[rank < k], at[rank < k]
    return pd.DataFrame({
        "user_id": users[row], "neighbor_id": others[at], "similarity": score[row, at],
    })


def top_k_of_tile(metric: str, k: int):
    """For each user of a tile its k best partners in it, in both directions."""

    def emit(heavy: pd.DataFrame, light: pd.DataFrame) -> pd.DataFrame:
        if heavy.empty:
            return NO_PAIRS
        left, right, table, mask, same = open_tile(heavy, light, metric)
        parts = [best_of_rows(left.users, right.users, table, mask, k)]
        if not same:
            parts.append(best_of_rows(right.users, left.users, table.T, mask.T, k))
        return pd.concat(parts)

    return emit


def tile_top_k(rows: DataFrame, settings: FitSettings, metric: str, k: int) -> DataFrame:
    """For each tiled user its k best partners in each tile, in both directions."""
    return per_tile(tiled_rows(rows, settings), light_rows(rows, settings), top_k_of_tile(metric, k), PAIR_SCHEMA)


def wanted_sums(wanted: pd.DataFrame, users: Block, others: Block, table) -> pd.DataFrame:
    """Weighted deviation sums of the wanted cells of ``users`` over raters in ``others``."""
    cells = wanted[np.isin(wanted["user_id"], users.users) & np.isin(wanted["item_id"], others.items)]
    cells = cells.sort_values("item_id", kind="stable")
    row = np.searchsorted(users.users, cells["user_id"].to_numpy())
    items, first = np.unique(cells["item_id"].to_numpy(), return_index=True)
    span = np.append(first, len(cells))
    num, den = np.zeros(len(cells)), np.zeros(len(cells))
    for n, i in enumerate(np.searchsorted(others.items, items)):
        asked, raters = slice(span[n], span[n + 1]), others.raters(i)
        weights = table[np.ix_(row[asked], others.row[raters])]
        num[asked] = weights @ others.dev[raters]
        den[asked] = np.abs(weights).sum(axis=1)
    return pd.DataFrame({
        "user_id": cells["user_id"].to_numpy(), "item_id": cells["item_id"].to_numpy(),
        "num": num, "den": den,
    })


def term_sums(light: pd.DataFrame, left: Block, right: Block, table: np.ndarray) -> pd.DataFrame:
    """Light terms of a tile weighted by the similarity of their pair, summed by wanted cell."""
    terms, a, b = places(light[light["kind"] != SUM], left, right)
    weight = table[a, b]
    wants = np.where(terms["kind"] == FOR_FIRST, terms["first"], terms["second"])
    found = pd.DataFrame({
        "user_id": wants, "item_id": terms["item_id"].to_numpy(),
        "num": weight * terms["value"].to_numpy(), "den": np.abs(weight),
    })
    return found.groupby(["user_id", "item_id"], as_index=False).sum()


def tile_sums(
    rows: DataFrame, settings: FitSettings, metric: str, wanted: DataFrame, terms: DataFrame
) -> DataFrame:
    """Partial weighted sums of wanted cells of tiled users over tiled raters.

    Cells of hot items meet their raters in the tiles (``wanted``: user_id, item_id, tiled, hot); cells of light items
    bring them along (``terms``: a wants, b rated, item_id, value).
    """

    def emit(heavy: pd.DataFrame, light: pd.DataFrame) -> pd.DataFrame:
        asked = heavy[heavy["wanted"]]
        if len(asked) == len(heavy) or asked.empty and not (light["kind"] != SUM).any():
            return pd.DataFrame({"user_id": [], "item_id": [], "num": [], "den": []})
        left, right, table, _, same = open_tile(heavy, light, metric)
        parts = [term_sums(light, left, right, table)]
        parts.append(wanted_sums(asked[asked["block"] == heavy["tile_i"].iat[0]], left, right, table))
        if not same:
            parts.append(
                wanted_sums(asked[asked["block"] == heavy["tile_j"].iat[0]], right, left, table.T)
            )
        return pd.concat(parts)

    return per_tile(tiled_rows(rows, settings, wanted), light_rows(rows, settings, terms), emit, SUM_SCHEMA)


def tile_stats(rows: DataFrame, settings: FitSettings, metric: str) -> DataFrame:
    """One partial statistics row per tile."""

    def emit(heavy: pd.DataFrame, light: pd.DataFrame) -> pd.DataFrame:
        if heavy.empty:
            return pd.DataFrame({c: [] for c in ("shared", "nonzero", "total", "squares", "low", "high")})
        _, _, table, mask, same = open_tile(heavy, light, metric)
        values = table[np.triu(mask) if same else mask]
        return pd.DataFrame({
            "shared": [values.size], "nonzero": [np.count_nonzero(values)],
            "total": [values.sum()], "squares": [(values * values).sum()],
            "low": [values.min() if values.size else None],
            "high": [values.max() if values.size else None],
        })

    return per_tile(tiled_rows(rows, settings), light_rows(rows, settings), emit, STATS_SCHEMA)

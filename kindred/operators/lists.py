"""Co-raters sent as lists: similarities of all users where no item is hot and there are many pairs.

Joining the raters of an item makes a row for each pair and shared item, and each such row is shuffled.  Here the ratings
are divided by item first (no item is hot, so an item's list of raters is short), and a list goes to the users that
rated the item.  Users are hashed into as many parts as the number of products asks for, and all that a task has for a
part travels as one row of packed arrays (one list for all of an item's raters in the part).  A part's users have all their
co-raters in it, so sums, ranks and predictions are formed there by numpy and need no shuffle of pairs.  The
cells to be predicted meet the lists of their items' raters in the same tasks and travel with them.

A part holds PART_PAIRS products on average, whatever the data.  The tasks that make lists send PARTS_SENT parts' worth, so their
number follows from the products, too, and none has to spill.  Few products are left to the join
(operators.pairs), and so are users whose own products could be more than a part should hold.

Many parts are served in rounds: the ratings are divided by item once and kept, a round sends lists to its share of the
users only, and what its parts make of them is kept before the lists are removed.  The lists, by far the largest shuffle,
so never lie on disk all at once.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.vectors import Fitted
from kindred.schema import SIMILARITY_PLACES
from kindred.sources.staging import release, stage

# Ship the functions below with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Products of a part on average, and the most that one user may bring.
PART_PAIRS = 3_000_000
USER_PAIRS = 6_000_000
# A task that makes lists serves so many parts' worth of products (the fewer only as far as there are so many tasks),
# so many products at a time.  The more, the larger are the rows that it sends to a part.
PARTS_SENT = (2, 16)
SENDERS = 96
SENT_PAIRS = 64_000_000
# At most so many rounds, of so many parts or more: a round reads all ratings again.
ROUNDS = 8
ROUND_PARTS = 24
# So many values show whether values repeat.
SHOWN = 512

# Pairs sorted by similarity at a time: user, similarity and position then fit in one number.
SORTED_PAIRS = 1 << 19

PAIR_SCHEMA = "user_id bigint, neighbor_id bigint, similarity double"
STATS_SCHEMA = "shared bigint, nonzero bigint, total double, squares double, low double, high double"
PACKED_PAIRS = ["users", "neighbors", "steps", "similarity"]
PACKED = ["widths", "counts", "firsts", "steps", "values", "owners"]


def part_count(fitted: Fitted) -> int | None:
    """How many parts the products ask for; None where the join is to be used.

    One row reaches the driver: the number of products, and the longest lists.
    """
    if fitted.hot_items is not None:
        return None
    rows = fitted.vectors if fitted.light is None else fitted.light
    degrees = rows.where("user_id is not null and item_id is not null").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    raters = degrees.agg(F.sum(F.col("n") * F.col("n")).alias("products"), F.max("n").alias("raters")).first()
    rated = fitted.users.agg(F.max("n_rated")).first()[0]
    if raters.products is None or raters.products <= PART_PAIRS or rated * raters.raters > USER_PAIRS:
        return None
    return -(-raters.products // PART_PAIRS)


def _planes(values: np.ndarray) -> bytes:
    """An array's bytes, first those of one place and then those of the next, compressed."""
    places = values.view(np.uint8).reshape(len(values), values.itemsize)
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(places.T), codec="zstd", asbytes=True)


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    count, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    places = np.frombuffer(pa.decompress(data[8:], decompressed_size=count * size, codec="zstd", asbytes=True), np.uint8)
    found = np.empty((count, size), np.uint8)
    for i in range(size):
        found[:, i] = places[i * count: (i + 1) * count]
    return found.view(kind).reshape(count)


def senders(parts: int) -> int:
    """How many tasks make lists for so many parts."""
    few, many = PARTS_SENT
    return max(1, min(parts // few, max(SENDERS, parts // many)))


def round_count(parts: int) -> int:
    """In how many rounds so many parts are served."""
    return max(1, min(ROUNDS, parts // ROUND_PARTS))


def squeeze(values: np.ndarray) -> bytes:
    """An array compressed without loss; doubles that repeat as the different ones and, for each, which it is.

    Deviations repeat, as ratings have few values and means of equally many ratings few more.
    """
    if values.dtype == np.float64 and len(np.unique(values[:SHOWN])) < 0.9 * len(values[:SHOWN]):
        different, which = np.unique(values.view(np.int64), return_inverse=True)  # of the bits: not a number, too, comes back as it was
        if 2 * len(different) <= len(values):
            first = _planes(different)
            return len(first).to_bytes(8, "little") + first + _planes(which.astype(np.int32))
    return bytes(8) + _planes(values)


def expand(data: bytes, kind: type) -> np.ndarray:
    first = int.from_bytes(data[:8], "little")
    if not first:
        return _from_planes(data[8:], kind)
    return _from_planes(data[8:8 + first], kind)[_from_planes(data[8 + first:], np.int32)]


def in_order(keys: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys from 0 to below ``top``, sorted, and their positions; equal ones stay in order.

    Where a key and its position fit in one number, sorting these numbers takes a fraction of the time of an argsort.
    """
    bits = len(keys).bit_length()
    if top <= 1 << (63 - bits):
        packed = keys << bits | np.arange(len(keys))
        packed.sort()
        return packed >> bits, packed & ((1 << bits) - 1)
    order = np.argsort(keys, kind="stable")
    return keys[order], order


def spread(starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of runs of the given widths, one run after the other."""
    ends = np.cumsum(widths)
    return np.repeat(starts - (ends - widths), widths) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Raters:
    """Ratings in order of item and user: where each item starts, and its number of raters."""

    items: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    users: np.ndarray
    values: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, item: np.ndarray, user: np.ndarray, value: np.ndarray, part: np.ndarray) -> Raters:
        order = np.lexsort((user, item))
        item = item[order]
        starts = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1]))) if len(item) else np.zeros(0, np.int64)
        return cls(item[starts], starts, np.diff(starts, append=len(item)), user[order], value[order], part[order])


def _lists(raters: Raters, at: np.ndarray, parts: np.ndarray, skipped: np.ndarray, owners: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """Per part, the packed lists of its entries.

    An entry is a run of equal (part, item) in ``parts`` and ``at`` (an item's position in ``raters``), which are in that order;
    ``owners`` has arrays of a value for each; ``skipped``: how many raters of the item are left out.
    """
    new = np.concatenate(([True], (parts[1:] != parts[:-1]) | (at[1:] != at[:-1])))
    entry = np.flatnonzero(new)
    counts = np.diff(entry, append=len(at))
    starts, widths = raters.starts[at[entry]] + skipped[entry], raters.sizes[at[entry]] - skipped[entry]
    bounds = np.flatnonzero(np.concatenate(([True], np.diff(parts[entry]) != 0)))
    for low, high in zip(bounds, [*bounds[1:], len(entry)]):
        flat = spread(starts[low:high], widths[low:high])
        users = raters.users[flat]
        steps = np.diff(users, prepend=users[:1])
        begins = np.cumsum(widths[low:high]) - widths[low:high]
        steps[begins] = 0
        own = slice(entry[low], entry[high] if high < len(entry) else len(at))
        arrays = [widths[low:high].astype(np.int32), counts[low:high].astype(np.int32), users[begins], steps, raters.values[flat]]
        yield int(parts[entry[low]]), [squeeze(x) for x in [*arrays, *[np.ascontiguousarray(o[own]) for o in owners]]]


def _products(raters: Raters, half: bool) -> Iterator[tuple[int, list[bytes]]]:
    """Each rating of a user with a part of this round (the others' is -1) with its item's raters; with ``half`` for the sake of those with a larger id only."""
    last = np.cumsum(raters.sizes * raters.sizes) // SENT_PAIRS
    for chunk in np.split(np.arange(len(raters.sizes)), np.flatnonzero(np.diff(last)) + 1):
        if not len(chunk):
            continue
        rows = spread(raters.starts[chunk], raters.sizes[chunk])
        at = np.repeat(chunk, raters.sizes[chunk])
        place = rows - raters.starts[at]
        some = raters.parts[rows] >= 0
        if half:
            some &= place < raters.sizes[at] - 1
        rows, at, place = rows[some], at[some], place[some]
        if not len(rows):
            continue
        # Rows are in order of item and place already.
        part, order = in_order(raters.parts[rows].astype(np.int64), 1 << 31)
        at, place = at[order], place[order]
        new = np.concatenate(([True], (part[1:] != part[:-1]) | (at[1:] != at[:-1])))
        # Where only larger ids count, a list begins with the first of its owners.
        skipped = place[new][np.cumsum(new) - 1] if half else np.zeros(len(at), np.int64)
        yield from _lists(raters, at, part, skipped, [(place - skipped).astype(np.int32)])


def _cells(raters: Raters, item: np.ndarray, part: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """Wanted cells, ``columns`` of them, with their items' raters."""
    at = np.minimum(np.searchsorted(raters.items, item), max(0, len(raters.items) - 1))
    known = np.flatnonzero(raters.items[at] == item) if len(raters.items) else np.zeros(0, np.int64)
    order = known[np.lexsort((at[known], part[known]))]
    for chunk in np.split(order, np.flatnonzero(np.diff(np.cumsum(raters.sizes[at[order]]) // SENT_PAIRS)) + 1):
        if len(chunk):
            none = np.zeros(len(chunk), np.int64)
            yield from _lists(raters, at[chunk], part[chunk], none, [c[chunk] for c in columns])


def _numbers(column: pa.ChunkedArray, missing: float = np.nan) -> np.ndarray:
    """Values with ``missing`` for null."""
    return column.fill_null(missing).to_numpy()


def _by_item(rows: DataFrame, fitted: Fitted, metric: str, parts: int, cells: DataFrame | None) -> DataFrame:
    """The ratings, and the wanted cells (user_id, item_id, doubles), divided by item among the tasks that make lists.

    A rater without a usable rating is no part of a product, but counts among the raters of a cell.
    """
    value = {"cosine": F.col("pdev"), "jaccard": F.col("n_rated").cast("double"), "overlap": F.lit(0.0)}[metric]
    more = _more(cells)
    frame = (rows if cells is None else fitted.vectors).select(
        "item_id", "user_id", value.alias("value"), (F.lit(None) if cells is None else F.col("dev")).cast("double").alias("dev"),
        F.lit(False).alias("wanted"), *[F.lit(None).cast("double").alias(c) for c in more],
    )
    if cells is not None:
        none = F.lit(None).cast("double")
        frame = frame.unionByName(cells.select(
            "item_id", "user_id", none.alias("value"), none.alias("dev"), F.lit(True).alias("wanted"), *[F.col(c).cast("double") for c in more]
        ))
    frame = frame.where("user_id is not null and item_id is not null")
    # The part follows from the user, so it need not travel to the tasks that make lists.
    return frame.repartition(senders(parts), "item_id").withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int"))


def _more(cells: DataFrame | None) -> list[str]:
    return [] if cells is None else [c for c in cells.columns if c not in ("user_id", "item_id")]


def _kept(by_item: DataFrame) -> DataFrame:
    """The same, a task's rows together in one value, so that however they are read again an item's stay together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table, sink = pa.Table.from_batches(batches).sort_by("item_id"), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["ratings"])

    return stage(by_item.mapInArrow(run, "ratings binary"), "by-item")


def _sent(by_item: DataFrame, parts: int, half: bool, more: list[str] | None, rounds: int = 1, now: int = 0) -> DataFrame:
    """part, wanted (whether of cells) and packed arrays: the products of the users of this round's parts, and, unless ``more`` is
    None, their cells with columns ``more``.  With several rounds ``by_item`` is what ``_kept`` made."""
    asked = more is not None

    def lists_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        item, user, part = (table.column(c).to_numpy() for c in ("item_id", "user_id", "part"))
        part = np.where(part % rounds == now, part, -1)
        wanted = table.column("wanted").to_numpy()
        value, rated = _numbers(table.column("value")), ~wanted
        usable = rated & table.column("value").is_valid().to_numpy()
        found = [(False, _products(Raters.of(item[usable], user[usable], value[usable], part[usable]), half))]
        if asked:
            dev, served = _numbers(table.column("dev")), wanted & (part >= 0)
            columns = [user[served], item[served]]
            for c in more:
                columns += [_numbers(table.column(c), 0.0)[served], table.column(c).is_valid().to_numpy()[served].astype(np.uint8)]
            found.append((True, _cells(Raters.of(item[rated], user[rated], dev[rated], part[rated]), item[served], part[served], columns)))
        for kind, packed in found:
            rows, size = [], 0
            for at, arrays in packed:
                rows.append((at, arrays))
                size += sum(map(len, arrays))
                if size > 1 << 25:
                    yield _packed_rows(kind, rows)
                    rows, size = [], 0
            if rows:
                yield _packed_rows(kind, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rounds > 1:
            for batch in batches:
                for kept in batch.column(0):
                    yield from lists_of(pa.ipc.open_stream(kept.as_buffer()).read_all())
        elif batches := [b for b in batches if b.num_rows]:
            yield from lists_of(pa.Table.from_batches(batches))

    packed = by_item.mapInArrow(
        run, "part int, wanted boolean, " + ", ".join(f"{c} binary" for c in PACKED[:-1]) + ", owners array<binary>"
    )
    return packed.repartition(-(-parts // rounds), "part")


def _served(
    rows: DataFrame, fitted: Fitted, metric: str, parts: int, half: bool, emit: Callable, schema: str,
    cells: DataFrame | None = None, then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """What ``emit`` makes of each part, and ``then`` of that: of all of it, or in rounds of each round's, which are kept."""
    then, rounds = then or (lambda df: df), round_count(parts)
    more = None if cells is None else _more(cells)
    by_item = _by_item(rows, fitted, metric, parts, cells)
    if rounds == 1:
        return then(_in_parts(_sent(by_item, parts, half, more), emit, schema))
    by_item = _kept(by_item)
    found = [stage(then(_in_parts(_sent(by_item, parts, half, more, rounds, now), emit, schema)), "round") for now in range(rounds)]
    release(by_item)
    return reduce(DataFrame.unionByName, found)


def _packed_rows(wanted: bool, rows: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
    columns = [pa.array([r[1][i] for r in rows], pa.binary()) for i in range(len(PACKED) - 1)]
    owners = pa.array([r[1][len(PACKED) - 1:] for r in rows], pa.list_(pa.binary()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([wanted] * len(rows), pa.bool_()), *columns, owners], ["part", "wanted", *PACKED]
    )


@dataclass
class Unpacked:
    """Lists of one kind in a part: users and values, where each list starts, its width, and the owners' values."""

    starts: np.ndarray
    widths: np.ndarray
    counts: np.ndarray
    users: np.ndarray
    values: np.ndarray
    owners: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, rows: list[dict], kinds: list[type]) -> Unpacked:
        def together(name: str, kind: type) -> np.ndarray:
            return np.concatenate([expand(r[name], kind) for r in rows] or [np.zeros(0, kind)])

        widths, counts, firsts = together("widths", np.int32).astype(np.int64), together("counts", np.int32), together("firsts", np.int64)
        starts = np.cumsum(widths) - widths
        steps = np.cumsum(together("steps", np.int64))
        users = steps + np.repeat(firsts - steps[starts], widths)
        owners = [np.concatenate([expand(r["owners"][i], kind) for r in rows] or [np.zeros(0, kind)]) for i, kind in enumerate(kinds)]
        return cls(starts, widths, counts, users, together("values", np.float64), owners)


class Part:
    """The pairs of a part's users with their co-raters: arrays users, neighbors and similarity, by user and neighbour."""

    def __init__(self, products: Unpacked, metric: str, half: bool):
        place = products.owners[0].astype(np.int64)
        start, width = np.repeat(products.starts, products.counts), np.repeat(products.widths, products.counts)
        me = start + place
        if half:
            start, width = me + 1, width - place - 1
        flat = spread(start, width)
        other = products.users[flat]
        self.names, at = np.unique(products.users[me], return_inverse=True)
        at = np.repeat(at, width)
        self.low = int(other.min()) if len(other) else 0
        self.span = (int(other.max()) - self.low + 1) if len(other) else 1
        self.known = None
        if self.span * max(1, len(self.names)) >= 1 << 62:  # ids too far apart for one number per pair
            self.known = np.unique(other)
            self.span = len(self.known)
        key, order = in_order(at * self.span + self.place(other), self.span * max(1, len(self.names)))
        first = np.flatnonzero(np.diff(key, prepend=-1))
        picked = order[first]
        owner, other = self.names[at[picked]], other[picked]
        mine = lambda: np.repeat(products.values[me], width)
        if not len(first):
            similarity = np.zeros(0)
        elif metric == "cosine":
            similarity = np.add.reduceat((mine() * products.values[flat])[order], first)
        else:
            similarity = np.diff(first, append=len(key)).astype(float)
            if metric == "jaccard":
                union = mine()[picked] + products.values[flat[picked]] - similarity
                similarity = np.divide(similarity, union, out=np.zeros(len(first)), where=union > 0)
        if metric != "overlap":
            unit = 10.0 ** SIMILARITY_PLACES  # the same steps as functions.rounded
            similarity = np.floor(similarity * unit + 0.5) / unit
        apart = owner != other
        self.key, self.users, self.neighbors, self.similarity = key[first][apart], owner[apart], other[apart], similarity[apart]

    def place(self, ids: np.ndarray) -> np.ndarray:
        return ids - self.low if self.known is None else np.searchsorted(self.known, ids)

    def best_first(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the pairs by user, similarity and neighbour, and the rank of each."""
        users = self.users
        first = np.flatnonzero(np.concatenate(([True], users[1:] != users[:-1]))) if len(users) else np.zeros(0, np.int64)
        count = np.diff(first, append=len(users))
        # Rounded similarities are whole steps.  Equal ones stay by neighbour.
        steps = np.rint(self.similarity * 10.0 ** SIMILARITY_PLACES).astype(np.int64)
        order = np.empty(len(users), np.int64)
        groups = np.flatnonzero(np.diff(first // SORTED_PAIRS, prepend=-1))
        for low, high in zip(groups, [*groups[1:], len(first)]):
            own = slice(first[low], first[high] if high < len(first) else len(users))
            below = steps[own].max() - steps[own]
            span, user = int(below.max()) + 1, np.repeat(np.arange(high - low), count[low:high])
            if span * int(high - low) < 1 << 62:
                order[own] = first[low] + in_order(user * span + below, span * int(high - low))[1]
            else:
                order[own] = first[low] + np.lexsort((below, user))
        return order, np.arange(len(users)) - np.repeat(first, count) + 1

    def find(self, owner: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs (owner, other) are, and whether they are there."""
        if not len(self.key):
            return np.zeros(len(owner), np.int64), np.zeros(len(owner), bool)
        user = np.minimum(np.searchsorted(self.names, owner), len(self.names) - 1)
        inside = (self.names[user] == owner) & (other >= self.low)
        if self.known is None:
            inside &= other < self.low + self.span
            place = np.where(inside, other - self.low, 0)
        else:
            place = np.minimum(np.searchsorted(self.known, other), self.span - 1)
            inside &= self.known[place] == other
        key = user * self.span + place
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return at, inside & (self.key[at] == key)


def _in_parts(sent: DataFrame, emit: Callable, schema: str) -> DataFrame:
    """Run ``emit(rows of products, rows of cells)`` for each part that has rows, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                found.setdefault(row["part"], ([], []))[row["wanted"]].append(row)
        while found:
            yield emit(*found.popitem()[1])

    return sent.mapInArrow(run, schema)


def _batch(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _pairs(rows: list[dict], metric: str, half: bool) -> Part:
    return Part(Unpacked.of(rows, [np.int32]), metric, half)


def list_pairs(rows: DataFrame, fitted: Fitted, metric: str, parts: int) -> DataFrame:
    """Every co-rating pair, user_id < neighbor_id.  The pairs of a round are kept packed, a third of their size."""
    if round_count(parts) == 1:
        def emit(products, _):
            part = _pairs(products, metric, True)
            return _batch(user_id=part.users, neighbor_id=part.neighbors, similarity=part.similarity)

        return _served(rows, fitted, metric, parts, True, emit, PAIR_SCHEMA)

    def pack(products, _):
        part = _pairs(products, metric, True)
        return _batch(**{c: pa.array([x], pa.binary()) for c, x in zip(PACKED_PAIRS, packed_pairs(part.users, part.neighbors, part.similarity))})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch(**dict(zip(("user_id", "neighbor_id", "similarity"), unpacked_pairs(*[row[c] for c in PACKED_PAIRS]))))

    packed = _served(rows, fitted, metric, parts, True, pack, ", ".join(f"{c} binary" for c in PACKED_PAIRS))
    return packed.mapInArrow(unpack, PAIR_SCHEMA)


def packed_pairs(users: np.ndarray, neighbors: np.ndarray, similarity: np.ndarray) -> list[bytes]:
    """Pairs by user and neighbour, compressed without loss: a rounded similarity as a number of whole steps."""
    unit = 10.0 ** SIMILARITY_PLACES
    steps = np.rint(similarity * unit)
    whole = bool((np.abs(steps) < 1 << 31).all()) and (steps / unit).tobytes() == similarity.tobytes()
    return [_planes(np.diff(users, prepend=0)), _planes(np.diff(neighbors, prepend=0)), _planes(steps.astype(np.int32)) if whole else b"", b"" if whole else squeeze(similarity)]


def unpacked_pairs(users: bytes, neighbors: bytes, steps: bytes, similarity: bytes) -> list[np.ndarray]:
    ids = [np.cumsum(_from_planes(x, np.int64)) for x in (users, neighbors)]
    return [*ids, _from_planes(steps, np.int32) / 10.0 ** SIMILARITY_PLACES if steps else expand(similarity, np.float64)]


def list_stats(rows: DataFrame, fitted: Fitted, metric: str, parts: int) -> DataFrame:
    """One partial statistics row per part."""

    def emit(products, _):
        values = _pairs(products, metric, True).similarity
        return _batch(
            shared=np.array([values.size]), nonzero=np.array([np.count_nonzero(values)]),
            total=np.array([values.sum()]), squares=np.array([(values * values).sum()]),
            low=pa.array([values.min() if values.size else None], pa.float64()),
            high=pa.array([values.max() if values.size else None], pa.float64()),
        )

    return _served(rows, fitted, metric, parts, True, emit, STATS_SCHEMA)


def list_ranks(
    rows: DataFrame, fitted: Fitted, metric: str, k: int | None, parts: int, then: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """user_id, neighbor_id, similarity, rank for the k most similar co-raters, or all; or what ``then`` makes of them,
    which is called with the neighbours of some users at a time, all of each."""

    def emit(products, _):
        part = _pairs(products, metric, False)
        order, rank = part.best_first()
        if k is not None:
            order, rank = order[rank <= k], rank[rank <= k]
        return _batch(
            user_id=part.users[order], neighbor_id=part.neighbors[order],
            similarity=part.similarity[order], rank=rank.astype(np.int32),
        )

    return _served(rows, fitted, metric, parts, False, emit, f"{PAIR_SCHEMA}, rank int", then=then)


def _terms(products: list[dict], wanted: list[dict], metric: str, more: tuple[str, ...] = ()):
    """Wanted cells as arrays by column, and their terms: position of the cell, similarity, deviation and rank."""
    part = _pairs(products, metric, False)
    order, by_order = part.best_first()
    rank = np.empty(len(order), np.int64)
    rank[order] = by_order
    lists = Unpacked.of(wanted, [np.int64, np.int64, *[np.float64, np.uint8] * len(more)])
    cells = dict(zip(("user_id", "item_id"), lists.owners))
    for i, c in enumerate(more):
        cells[c] = pa.array(lists.owners[2 + 2 * i], mask=lists.owners[3 + 2 * i] == 0)
    width = np.repeat(lists.widths, lists.counts)
    cell, flat = np.repeat(np.arange(len(width)), width), spread(np.repeat(lists.starts, lists.counts), width)
    at, met = part.find(cells["user_id"][cell], lists.users[flat])
    at = at[met]
    return cells, cell[met], part.similarity[at], lists.values[flat[met]], rank[at]


def list_sums(
    rows: DataFrame, fitted: Fitted, metric: str, cells: DataFrame, ks: list[int | None], parts: int
) -> DataFrame:
    """user_id, item_id and, for each k, num_k and den_k: weighted sums of wanted cells over the k nearest (None: all) raters."""
    names = [f"{c}_{k}" for k in ks for c in ("num", "den")]

    def emit(products, wanted):
        cells, cell, similarity, dev, rank = _terms(products, wanted, metric)
        found = np.unique(cell)
        sums = []
        for k in ks:
            near = np.ones(len(cell), bool) if k is None else rank <= k
            for values in (similarity * dev, np.abs(similarity)):
                some = near & ~np.isnan(values)  # as in SQL, no deviation adds nothing, and the sum of nothing is null
                total, count = (np.bincount(cell[some], x, len(cells["user_id"]))[found] for x in (values[some], None))
                sums.append(pa.array(total, pa.float64(), mask=count == 0))  # of nothing, numpy counts in integers
        return _batch(user_id=cells["user_id"][found], item_id=cells["item_id"][found], **dict(zip(names, sums)))

    wanted = cells.select("user_id", "item_id").distinct()
    return _served(rows, fitted, metric, parts, False, emit, "user_id bigint, item_id bigint, " + ", ".join(f"{c} double" for c in names), wanted)


def list_steps(
    rows: DataFrame, fitted: Fitted, metric: str, cells: DataFrame, parts: int, then: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What ``then`` makes of some users' rows at a time: rating, user_mean and, at the rank k of each rater among a cell's neighbours, the sums up to it and (``_before``) before it.

    ``cells``: user_id, item_id, rating, user_mean.
    """

    def emit(products, wanted):
        cells, cell, similarity, dev, rank = _terms(products, wanted, metric, ("rating", "user_mean"))
        order = np.lexsort((rank, cell))
        cell, rank = cell[order], rank[order]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        count = np.diff(first, append=len(cell))
        sums = {}
        for name, values in (("num", (similarity * dev)[order]), ("den", np.abs(similarity)[order])):
            missing = np.isnan(values)
            upto, sums[f"{name}_before"] = running_sums(np.where(missing, 0.0, values), first, count)
            nothing = running_sums((~missing).astype(float), first, count)[0] == 0 if missing.any() else missing
            sums[name] = pa.array(upto, mask=nothing)
        about = {c: cells[c].take(pa.array(cell)) for c in ("rating", "user_mean")}
        return _batch(k=rank, **about, **{c: sums[c] for c in ("num", "num_before", "den", "den_before")})

    return _served(
        rows, fitted, metric, parts, False, emit,
        "k bigint, rating double, user_mean double, num double, num_before double, den double, den_before double", cells, then,
    )


def running_sums(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running totals within groups that begin at ``first``, with each value and before it.

    Added one place of all groups at a time, so that a group's sums never hold another group's digits.
    """
    upto, before = np.empty(len(values)), np.empty(len(values))
    total, at = np.zeros(len(first)), 0
    groups = np.argsort(-count, kind="stable")
    longest_first = count[groups]
    while at < (longest_first[0] if len(groups) else 0):
        live = groups[: np.searchsorted(-longest_first, -at, side="left")]
        place = first[live] + at
        before[place] = total[live]
        total[live] += values[place]
        upto[place] = total[live]
        at += 1
    return upto, before

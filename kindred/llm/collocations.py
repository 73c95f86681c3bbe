"""Phrase collocations: frequent phrases by mergeable Misra-Gries summaries, then exact counts.

First pass, in two rounds: words and pairs, then longer phrases whose pairs all survived.  Phrases
are hashed per language; the high half of a hash names one of many *hash partitions*, the low half is
the key in it.  Tasks count the keys of a few million words at a time and send each partition's
table to the partition's summary, so what is shuffled are sums.  A summary merges its tables in the way of Misra and
Gries: with more keys than its capacity, the largest count beyond the capacity is taken off all
keys, and keys at zero go.  The capacity exceeds the partition's mass (all occurrences in it) divided by the
threshold, so what is taken off stays below the threshold and every frequent phrase survives.

The survivors of a round become a bit table of bounded size, a slice for each partition, which the
next pass uses as a filter.  Second pass: phrases that pass the filter are counted exactly.  A task tells the
phrases of a stretch of text apart by their 64-bit hashes; tables of different stretches meet by the phrase's words, so the
filter's accidental bits decide nothing.  Where the survivors are too many for the filter, more
phrases pass it and are counted; the result is the same.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.hashing import byte_class, mix
from kindred.llm.spans import Chunk, chunks, runs
from kindred.operators.joins import join_per_key
from kindred.sources.staging import stage

#: What separates pieces, and words within pieces.
PIECE_ENDS = [*b".,;:!?", *range(0x0A, 0x0E)]
WORDS = byte_class([0x20, 0x09, *PIECE_ENDS])
BREAKS = ~byte_class(PIECE_ENDS)

#: Bytes of text for each hash partition, and the fewest partitions.
PARTITION_BYTES = 16 << 20
PARTITIONS = 64
#: Keys that a task gathers before it counts them and sends the counts.
GATHERED = 5_000_000
#: Different phrases that a task of the second pass counts before it sends the counts.
HELD = 400_000
#: The largest filter, in bits: 32 megabytes.  A partition's slice is at most SLICE_BITS.
FILTER_BITS = 1 << 28
SLICE_BITS = 1 << 21


class Filter:
    """One bit table for each hash partition."""

    def __init__(self, partitions: int, bits: int):
        self.partitions, self.bits = partitions, bits
        self.table = np.zeros(partitions * bits // 8, np.uint8)

    def fill(self, partition: int, packed: bytes) -> None:
        at = partition * self.bits // 8
        self.table[at: at + self.bits // 8] = np.frombuffer(packed, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes >> np.uint64(32)) % np.uint64(self.partitions) * np.uint64(self.bits) + (hashes & np.uint64(self.bits - 1))
        return (self.table[(place >> np.uint64(3)).view(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def slice_bits(partitions: int) -> int:
    """Bits of a partition's slice: a power of two, at least 8."""
    return max(8, min(SLICE_BITS, 1 << (max(1, FILTER_BITS // partitions).bit_length() - 1)))


def _seeds(languages: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """For each row the number of its language, the seed of each language's hashes, and the languages."""
    coded = languages.dictionary_encode()
    names = coded.dictionary.to_pylist()
    seeds = [int.from_bytes(hashlib.blake2b(n.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for n in names]
    return coded.indices.to_numpy().astype(np.int64), np.array(seeds, np.uint64), names


def _phrases(chunk: Chunk, seeds: np.ndarray, longest: int, filters: list[Filter]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, first words, hashes) of the phrases of each length that lie within a piece.

    With the filter of words and pairs, only phrases whose pairs all pass; with the filter of longer
    phrases, only those that pass it.
    """
    pieces = np.cumsum(BREAKS[chunk.codes])[chunk.starts] if len(chunk.starts) else np.empty(0, np.int64)
    paired = None
    for n, hashes in runs(chunk.hashes, longest):
        count = len(hashes)
        hashes = mix(hashes ^ seeds[:count])
        fits = pieces[:count] == pieces[n - 1: n - 1 + count]
        if filters and n <= 2:
            fits &= filters[0].has(hashes)
        if n == 2:
            paired = fits
        elif n > 2 and filters:
            for i in range(n - 1):
                fits &= paired[i: i + count]
        at = np.flatnonzero(fits)
        found = hashes[at]
        if n > 2 and len(filters) > 1:
            passed = filters[1].has(found)
            at, found = at[passed], found[passed]
        yield n, at, found


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and their counts."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.diff(first, append=len(keys))


def merged(keys: np.ndarray, counts: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary of tables laid end to end: keys, counts, and what was taken off each count.

    An occurrence is taken off together with at least ``capacity`` others, so what is taken off is at most
    mass / (capacity + 1), which is below the threshold.
    """
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    capacity = int(counts.sum()) // threshold + 1
    if len(keys) <= capacity:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    stays = counts > off
    return keys[stays], counts[stays] - off, off


def _tables(docs: DataFrame, partitions: int, lengths: range, shared) -> DataFrame:
    """(part, ones, many, counts): keys met once, other keys and their counts, of one stretch of text."""

    def send(gathered: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = _counted(np.concatenate(gathered or [np.empty(0, np.uint64)]))
        part = (keys >> np.uint64(32)) % np.uint64(partitions)
        order = np.argsort(part, kind="stable")
        keys, counts, bounds = keys[order].astype(np.uint32), counts[order].astype(np.uint32), np.searchsorted(part[order], np.arange(partitions + 1))
        columns = ([], [], [], [])
        for p in np.flatnonzero(np.diff(bounds)):
            own, times = keys[bounds[p]: bounds[p + 1]], counts[bounds[p]: bounds[p + 1]]
            for column, value in zip(columns, (int(p), own[times == 1].tobytes(), own[times > 1].tobytes(), times[times > 1].tobytes())):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["part", "ones", "many", "counts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        gathered, size = [], 0
        for batch in batches:
            codes, seeds, _ = _seeds(batch.column(0))
            for chunk in chunks(batch.column(1), WORDS, BREAKS):
                for n, _, hashes in _phrases(chunk, seeds[codes[chunk.rows]], lengths[-1], filters):
                    if n in lengths:
                        gathered.append(hashes)
                        size += len(hashes)
                if size > GATHERED:
                    yield send(gathered)
                    gathered, size = [], 0
        yield send(gathered)

    return docs.mapInArrow(run, "part int, ones binary, many binary, counts binary")


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32)


def survivors(docs: DataFrame, partitions: int, lengths: range, filters: list[Filter], threshold: int) -> Filter:
    """The filter of the phrases of these lengths that can occur ``threshold`` times."""
    bits = slice_bits(partitions)

    def summary(key: tuple, table: pa.Table) -> pa.Table:
        ones, many, counts = (_joined(table.column(c)) for c in ("ones", "many", "counts"))
        keys = np.concatenate((ones, many))
        counts = np.concatenate((np.ones(len(ones), np.int64), counts.astype(np.int64)))
        keys, counts, off = merged(keys, counts, threshold)
        flags = np.zeros(bits, bool)
        flags[keys[counts + off >= threshold] & np.uint32(bits - 1)] = True
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([packed], pa.binary())})

    shared = docs.sparkSession.sparkContext.broadcast(filters)
    tables = _tables(docs, partitions, lengths, shared)
    found = Filter(partitions, bits)
    # The driver gets one slice for each partition: FILTER_BITS at most, whatever the input.
    slices = tables.groupBy("part").applyInArrow(summary, "part int, bits binary").toArrow()
    for part, packed in zip(slices.column("part").to_pylist(), slices.column("bits")):
        found.fill(part, packed.as_py())
    return found


class _Counter:
    """Counts of the phrases of a task by hash, with the words of each."""

    def __init__(self):
        self.hashes, self.counts, self.at = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.lang, self.phrase, self.words = [], [], []

    def add(self, chunk: Chunk, langs: np.ndarray, names: list[str], n: int, at: np.ndarray, hashes: np.ndarray) -> None:
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))
        found, times = ordered[first], np.diff(first, append=len(ordered))
        place = np.searchsorted(self.hashes, found)
        known = np.zeros(len(found), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == found[inside]
        self.counts[self.at[place[known]]] += times[known]
        new = ~known
        where = at[order[first[new]]]
        self.lang += [names[i] for i in langs[where].tolist()]
        self.phrase += [b" ".join(chunk.data[a:b].split()) for a, b in zip(chunk.starts[where].tolist(), chunk.ends[where + n - 1].tolist())]
        self.words += [n] * len(where)
        self.at = np.insert(self.at, place[new], np.arange(len(self.counts), len(self.counts) + len(where)))
        self.hashes = np.insert(self.hashes, place[new], found[new])
        self.counts = np.concatenate((self.counts, times[new]))

    def rows(self, partitions: int) -> pa.RecordBatch:
        """A row for each hash partition, with lists of its phrases and their counts."""
        hashes = np.empty(len(self.counts), np.uint64)
        hashes[self.at] = self.hashes
        part = ((hashes >> np.uint64(32)) % np.uint64(partitions)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        parts, first = np.unique(part[order], return_index=True)
        bounds, taken = pa.array(np.append(first, len(order)).astype(np.int32)), pa.array(order)
        columns = [pa.array(self.lang, pa.string()), pa.array(self.phrase, pa.binary()).cast(pa.string()), pa.array(self.words, pa.int32()), pa.array(self.counts)]
        return _listed(parts, [pa.ListArray.from_arrays(bounds, c.take(taken)) for c in columns])


def _listed(parts: np.ndarray, lists: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *lists], ["part", "lang", "phrase", "n_words", "a"])


def phrase_counts(docs: DataFrame, partitions: int, longest: int, filters: list[Filter], threshold: int) -> DataFrame:
    """(lang, phrase, n_words, a): exact counts of all phrases of 1 to ``longest`` words that occur ``threshold``
    times, and of each language's words together (phrase null, n_words 0).

    Tasks send their sums by hash partition, as lists; a partition adds them up by the phrases themselves.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        counter, totals = _Counter(), Counter()
        for batch in batches:
            codes, seeds, names = _seeds(batch.column(0))
            for chunk in chunks(batch.column(1), WORDS, BREAKS):
                langs = codes[chunk.rows]
                totals.update(dict(zip(names, np.bincount(langs, minlength=len(names)).tolist())))
                for n, at, hashes in _phrases(chunk, seeds[langs], longest, filters):
                    counter.add(chunk, langs, names, n, at, hashes)
                if len(counter.phrase) > HELD:
                    yield counter.rows(partitions)
                    counter = _Counter()
        yield counter.rows(partitions)
        parts = [zlib.crc32(name.encode("utf-8", "surrogatepass")) % partitions for name in totals]
        single = lambda values, kind: pa.array([[v] for v in values], pa.list_(kind))
        yield _listed(np.array(parts, np.int32), [
            single(totals, pa.string()), single([None] * len(totals), pa.string()), single([0] * len(totals), pa.int32()), single(totals.values(), pa.int64())
        ])

    def add_up(table: pa.Table) -> pa.Table:
        lists = {c: table.column(c).combine_chunks() for c in ("lang", "phrase", "n_words", "a")}
        flat = pa.table({c: (x.flatten() if isinstance(x, pa.ListArray) else pa.concat_arrays([y.flatten() for y in x.chunks])) for c, x in lists.items()})
        sums = flat.group_by(["lang", "phrase", "n_words"]).aggregate([("a", "sum")]).rename_columns(["lang", "phrase", "n_words", "a"])
        return sums.filter(pc.or_(pc.greater_equal(sums["a"], threshold), pc.equal(sums["n_words"], 0)))

    sent = docs.mapInArrow(run, "part int, lang array<string>, phrase array<string>, n_words array<int>, a array<long>")
    return sent.groupBy("part").applyInArrow(add_up, "lang string, phrase string, n_words int, a long")


def _part(column: str, first: Column, size: Column) -> Column:
    """Some of a phrase's words."""
    words = F.split(column, " ")
    return F.array_join(F.slice(words, first, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, n_words, a, l, r, n, score) of the phrases of two words or more: the cut with the lowest score, ties to the first."""
    totals = counts.where("n_words = 0").select("lang", F.col("a").alias("n"))
    single = counts.where("n_words > 0")
    cuts = single.where("n_words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.withColumn("left", _part("phrase", F.lit(1), F.col("k"))).withColumn("right", _part("phrase", F.col("k") + 1, F.col("n_words") - F.col("k")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(single.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), ["lang", side])
    cuts = join_per_key(cuts, totals, "lang", "phrase")
    exact = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    cuts = cuts.withColumn("over", exact("a", 18) * F.lit(1000).cast("decimal(4,0)") * exact("n", 15)).withColumn("under", exact("l", 18) * exact("r", 18))
    cuts = cuts.withColumn("score", F.expr("over div under"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "n_words", "a", "n").agg(best).select("lang", "phrase", "n_words", "a", "cut.l", "cut.r", "n", "cut.score")


def outermost(phrases: DataFrame, percent: int = 100) -> DataFrame:
    """Phrases that no longer one holds nearly always: those inside a longer phrase with 100 * f(longer) >= percent * a go.

    Looking one word further is enough: a phrase's occurrences are at least those of any phrase that holds it.
    """
    longer = phrases.where("n_words > 2")
    inner = longer.select("lang", F.col("a").alias("outer"), F.explode(F.array(
        _part("phrase", F.lit(1), F.col("n_words") - 1), _part("phrase", F.lit(2), F.col("n_words") - 1)
    )).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    held = F.coalesce(100 * F.col("outer") >= percent * F.col("a"), F.lit(False))
    return phrases.join(covered, ["lang", "phrase"], "left").where(~held).drop("outer")


def collocations(docs: DataFrame, threshold: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    ``docs``: text and lang; other columns are ignored.  A-Z are lower-cased; pieces end at ``.,;:!?`` and line
    ends, words at blanks and tabs.  A null lang is ``und``, a null text is empty, rows that repeat count as often
    as they occur.  Equal scores go by count, then by the phrase's bytes.  Without a phrase that
    occurs ``threshold`` times the result is empty.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    partitions = max(PARTITIONS, -(-size // PARTITION_BYTES))
    filters: list[Filter] = []
    for lengths in (range(1, 3), range(3, longest + 1)):
        if len(lengths):
            filters = [*filters, survivors(docs, partitions, lengths, filters, threshold)]
    counts = stage(phrase_counts(docs, partitions, longest, filters, threshold), "phrases")
    phrases = outermost(scored(counts))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Ranked lexical search over posting lists that are cut into blocks of similar documents.

Documents are read in shards of bounded size.  A shard holds its documents' impacts, the part of a
term's score that does not depend on the query, and for each term a posting list.  A list is clustered by
document similarity: its documents are ordered by the signs of random projections of their weighted
terms and cut into blocks.  A block's summary is the coordinatewise maximum of its documents'
impacts, so the weighted sum of a summary over a query's terms bounds the score of every document in the block.
A query scores its most promising blocks first; blocks whose bound is below its k-th best score are skipped, all
others are scored.  Nothing else is skipped, so results are exact.  The k best go with a task from shard to shard.

Queries are a stated set and are taken in portions of bounded size; documents are cut to the
terms of a portion when they are read.  Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.hashing import ALPHANUMERIC
from kindred.llm.spans import chunks, slices
from kindred.sources.staging import stage

#: (query, term) pairs of a portion of queries: what is broadcast at once.
PORTION = 1 << 20
#: Terms of the queries that a shard answers together, and cells of its document x term table.
TOGETHER = 1 << 14
CELLS = 6 << 20
SHARD = 2048
#: A list has at most BLOCKS blocks, of BLOCK documents at least.  Summaries of a shard have at most
#: SUMMARIES cells; queries with so many terms that they would not fit are scored without skipping.
BLOCK, BLOCKS = 16, 8
SUMMARIES = 24 << 20
PROJECTIONS = 16
#: So many blocks are scored before the threshold is looked at again.
FIRST = 4


@dataclass
class Queries:
    """Queries with their terms as places in ``vocabulary`` (sorted hashes) and the terms' weights."""

    ids: np.ndarray
    terms: list[np.ndarray]
    vocabulary: np.ndarray
    weights: np.ndarray

    def groups(self) -> list[range]:
        """Queries to be answered together."""
        ends = np.cumsum([len(t) for t in self.terms])
        cuts = [0]
        while cuts[-1] < len(self.ids):
            done = ends[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + TOGETHER, "right"))))
        return [range(a, b) for a, b in zip(cuts, cuts[1:])]


class Best:
    """The k best (score, id) of a query: highest score first, ties by smaller id."""

    def __init__(self, k: int):
        self.k, self.threshold = k, 0
        self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= max(self.threshold, 1)
        if not good.any():
            return
        ids, scores = np.concatenate((self.ids, ids[good])), np.concatenate((self.scores, scores[good]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.k:
            self.threshold = int(self.scores[-1])


class Shard:
    """Impacts of some documents on some terms, and the terms' lists in blocks.

    ``impacts``: documents x terms, integers.  ``weights``: of the terms.
    """

    def __init__(self, ids: np.ndarray, impacts: np.ndarray, weights: np.ndarray):
        self.weights = weights
        planes = np.random.default_rng(5).choice(np.array([-1, 1], np.float32), (len(weights), PROJECTIONS))
        signs = impacts.astype(np.float32) @ (weights[:, None].astype(np.float32) * planes) > 0
        code = signs @ (1 << np.arange(PROJECTIONS)[::-1])
        order = np.lexsort((ids, code))
        self.ids, self.impacts = ids[order], impacts[order]
        term, self.docs = np.nonzero(self.impacts.T)
        self.first = np.searchsorted(term, np.arange(len(weights) + 1))
        self.skips = len(weights) * len(weights) <= SUMMARIES
        if self.skips:
            self._cut(max(1, min(BLOCKS, SUMMARIES // max(1, len(weights)) ** 2)))

    def _cut(self, most: int) -> None:
        lengths = np.diff(self.first)
        size = np.maximum(BLOCK, -(-lengths // most))
        count = -(-lengths // size)
        self.block_of = np.concatenate(([0], np.cumsum(count)))
        within = np.arange(self.block_of[-1]) - np.repeat(self.block_of[:-1], count)
        self.start = np.repeat(self.first[:-1], count) + within * np.repeat(size, count)
        self.end = np.minimum(self.start + np.repeat(size, count), np.repeat(self.first[1:], count))
        self.summary = np.empty((len(self.start), len(self.weights)), self.impacts.dtype)
        for b, (i, j) in enumerate(zip(self.start.tolist(), self.end.tolist())):
            self.impacts[self.docs[i:j]].max(axis=0, out=self.summary[b])

    def scores(self, docs: np.ndarray, terms: np.ndarray) -> np.ndarray:
        return self.impacts[np.ix_(docs, terms)].astype(np.int64) @ self.weights[terms]

    def bounds(self, blocks: np.ndarray, terms: np.ndarray) -> np.ndarray:
        return self.summary[np.ix_(blocks, terms)].astype(np.int64) @ self.weights[terms]

    def _of_blocks(self, blocks: np.ndarray) -> np.ndarray:
        parts = [self.docs[self.start[b]: self.end[b]] for b in blocks]
        return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.intp)

    def answer(self, terms: np.ndarray, best: Best) -> tuple[int, int]:
        """Add what this shard has for a query to its best; (blocks, blocks skipped)."""
        terms = terms[self.first[terms + 1] > self.first[terms]]
        if not len(terms):
            return 0, 0
        if not self.skips:
            docs = np.unique(np.concatenate([self.docs[self.first[t]: self.first[t + 1]] for t in terms]))
            best.add(self.ids[docs], self.scores(docs, terms))
            return 0, 0
        blocks = np.concatenate([np.arange(self.block_of[t], self.block_of[t + 1]) for t in terms])
        bounds = self.bounds(blocks, terms)
        order = np.argsort(-bounds, kind="stable")
        blocks, bounds = blocks[order], bounds[order]
        scored, seen = 0, np.empty(0, np.intp)
        while scored < len(blocks):
            # A bound equal to the threshold is not skipped: a smaller id may tie.
            alive = int(np.searchsorted(-bounds, -max(best.threshold, 1), "right"))
            if alive <= scored:
                break
            upto = min(alive, FIRST) if scored == 0 else alive
            docs = np.setdiff1d(self._of_blocks(blocks[scored:upto]), seen, assume_unique=True)
            best.add(self.ids[docs], self.scores(docs, terms))
            seen, scored = np.union1d(seen, docs), upto
        return len(blocks), len(blocks) - scored


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item, as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                for chunk in chunks(batch.column(1).slice(first, last - first), ALPHANUMERIC, ~ALPHANUMERIC):
                    ids = batch.column(0).slice(first, last - first).take(pa.array(chunk.rows))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(chunk.hashes.view(np.int64))], ["item_id", "term"])

    return items.mapInArrow(run, "item_id long, term long").distinct()


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs): the length of each document, and how often terms of the vocabulary occur."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for first, last in slices(batch.column(1)):
                count = last - first
                lengths, keys = np.zeros(count, np.int64), []
                for chunk in chunks(batch.column(1).slice(first, count), ALPHANUMERIC, ~ALPHANUMERIC):
                    lengths += np.bincount(chunk.rows, minlength=count)
                    at = np.minimum(np.searchsorted(known, chunk.hashes), len(known) - 1)
                    hit = known[at] == chunk.hashes
                    keys.append(chunk.rows[hit] * len(known) + at[hit])
                keys, tfs = np.unique(np.concatenate(keys or [np.empty(0, np.int64)]), return_counts=True)
                ends = np.searchsorted(keys, np.arange(count + 1) * len(known)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (keys % max(1, len(known)), tfs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, count), pa.array(lengths), *lists], ["doc_id", "n", "terms", "tfs"]
                )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def answers(rows: DataFrame, queries: Queries, documents: int, length: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): at least the k best documents of each query, from ``vectors``."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best = [Best(k) for _ in queries.ids]
        groups = []
        for group in queries.groups():
            own = np.unique(np.concatenate([queries.terms[q] for q in group]))
            groups.append((own, [(q, np.searchsorted(own, queries.terms[q])) for q in group]))
        widest = max((len(own) for own, _ in groups), default=1)
        size = max(16, min(SHARD, CELLS // widest))
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                ids = part.column(0).to_numpy()
                m = np.array([100 - 90 + 90 * n * documents // length for n in part.column(1).to_pylist()], dtype=np.int64)
                terms, counts = _flat(part.column(2))
                tfs, _ = _flat(part.column(3))
                row = np.repeat(np.arange(len(ids)), counts)
                found = impact(tfs.astype(np.int64), m[row]).astype(np.int32)
                for own, asked in groups:
                    at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                    mine = own[at] == terms
                    if not mine.any():
                        continue
                    table = np.zeros((len(ids), len(own)), np.int32)
                    table[row[mine], at[mine]] = found[mine]
                    shard = Shard(ids, table, queries.weights[own])
                    for q, places in asked:
                        shard.answer(places, best[q])
        counts = [len(b.ids) for b in best]
        empty = [np.empty(0, np.int64)]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(queries.ids, counts)), pa.array(np.concatenate([b.ids for b in best] or empty)),
            pa.array(np.concatenate([b.scores for b in best] or empty)),
        ], ["item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def _portion(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The answers to one portion of queries.  Its pairs, PORTION or the terms of one item, reach the driver."""
    pairs = asked.select("item_id", "term").toArrow()
    items, terms = pairs.column("item_id").to_numpy(), pairs.column("term").to_numpy().view(np.uint64)
    if not len(items):
        return docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    vocabulary, place = np.unique(terms, return_inverse=True)
    ids, item = np.unique(items, return_inverse=True)
    order = np.lexsort((place, item))
    lists = np.split(place[order], np.searchsorted(item[order], np.arange(1, len(ids))))
    rows = stage(vectors(docs, vocabulary), "vectors")
    documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighted = held.select("term", weight.alias("weight")).toArrow()
    weights = np.zeros(len(vocabulary), np.int64)
    weights[weighted.column("term").to_numpy()] = weighted.column("weight").to_numpy()
    return answers(rows, Queries(ids, lists, vocabulary, weights), documents, max(1, length), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of every item: item_id, rank (from 1), doc_id, score.

    ``docs``: doc_id and text, ``items``: item_id and text; other columns are ignored.  Null and empty texts have no
    term; such documents are found by nothing and such items find nothing.  Rows with a null id are left
    out, of the statistics too.  Rows that repeat an item_id are one item with the terms of all;
    each row of ``docs`` is a document.  Equal scores go to the smaller doc_id; only scores above 0 are returned.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    asked = stage(_terms(items), "asked")
    portions = max(1, -(-asked.count() // PORTION))
    portion = F.pmod(F.xxhash64("item_id"), F.lit(portions))
    found = reduce(DataFrame.unionByName, [_portion(docs, asked.where(portion == i), k) for i in range(portions)])
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

"""Quality rules: gradient-boosted trees over statistics of documents.

One pass over the texts gathers the statistics of every document.  The trees are fitted on the
statistics of a bounded sample of labelled documents, by second-order boosting of the logistic loss over
histograms of quantile bins.  Chosen statistics have a monotonic constraint: splits that contradict it are not
made, and both sides of a split keep to bounds around their common middle, so that no deeper split
undoes it.  A fitted model is flattened into arrays of nodes; a batch walks all trees at once, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.hashing import BASE, SPACED, byte_class, mix
from kindred.llm.spans import slices, texts_of, word_spans
from kindred.sources.staging import stage

#: At most so many labelled documents of each class are used to fit; which ones, a hash decides.
SAMPLE = 20_000
TREES, DEPTH, RATE = 60, 3, 0.2
BINS, LEAST, RIDGE = 64, 5.0, 1.0

#: What counts as a symbol, and the limits of the base rules.
SYMBOLS = ~byte_class(b"#*$%&|<>")
FEWEST_WORDS, MOST_REPEATED = 50, 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_letters"]
_UPPER = ~byte_class(range(0x41, 0x5B))
_DIGIT = ~byte_class(range(0x30, 0x3A))
_MARK = ~byte_class(b"!?.,;:\"'()-")
_LETTER = ~byte_class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)])
_LEAD = byte_class(range(0x80, 0xC0))

#: The features of the trees, and whether more of one may only raise (1) or only lower (-1) the score.
FEATURES = {
    "symbols_per_word": -1, "repeated_share": -1, "repeated_lines": -1, "upper_share": -1,
    "words": 0, "word_length": 0, "marks_per_word": 0, "digits_per_word": 0, "words_per_line": 0,
}


def _sums(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    total = np.concatenate(([0], np.cumsum(mask)))
    return np.diff(total[ends], prepend=0)


def repeated_lines(text: bytes) -> tuple[int, int]:
    """(lines with a word, how many of them equal an earlier line)."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def repeated_words(hashes: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """For each text the words in windows of three words that the text has at least twice."""
    if len(hashes) < 3:
        return np.zeros(count, np.int64)
    base = np.uint64(BASE)
    salted = mix(hashes + mix(rows.astype(np.uint64) + np.uint64(7)))
    windows = mix(mix(mix(salted[:-2]) * base + salted[1:-1]) * base + salted[2:])
    inside = np.flatnonzero(rows[:-2] == rows[2:])
    order = inside[np.argsort(windows[inside], kind="stable")]
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return np.bincount(rows[covered], minlength=count)


def statistics(texts: list[bytes]) -> list[np.ndarray]:
    """The columns COUNTS of some texts (UTF-8)."""
    count = len(texts)
    codes = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, count) + 1)
    starts, stops, hashes = word_spans(codes, SPACED)
    rows = np.searchsorted(ends, starts, "right")
    text_ends = np.minimum(ends, len(codes))
    characters = np.concatenate(([0], np.cumsum(_LEAD[codes])))
    lines = [repeated_lines(t) for t in texts]
    # Sums of character counts stay far below 2**53, so float weights are exact.
    per_text = lambda values: np.bincount(rows, weights=values, minlength=count).astype(np.int64)
    table = {
        "n_words": np.bincount(rows, minlength=count), "word_chars": per_text(characters[stops] - characters[starts]),
        "n_symbols": _sums(SYMBOLS[codes], text_ends), "n_dup_lines": np.array([d for _, d in lines], np.int64),
        "n_repeat_words": repeated_words(hashes, rows, count), "n_lines": np.array([n for n, _ in lines], np.int64),
        "n_upper": _sums(_UPPER[codes], text_ends), "n_digits": _sums(_DIGIT[codes], text_ends),
        "n_marks": _sums(_MARK[codes], text_ends), "n_letters": _sums(_LETTER[codes], text_ends),
    }
    return [table[c].astype(np.int64) for c in COUNTS]


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The columns FEATURES of the columns COUNTS."""
    c = {name: counts[name].astype(np.float64) for name in COUNTS}
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    found = {
        "symbols_per_word": c["n_symbols"] / words, "repeated_share": c["n_repeat_words"] / words,
        "repeated_lines": c["n_dup_lines"] / lines, "upper_share": c["n_upper"] / np.maximum(c["n_letters"], 1),
        "words": c["n_words"], "word_length": c["word_chars"] / words, "marks_per_word": c["n_marks"] / words,
        "digits_per_word": c["n_digits"] / words, "words_per_line": c["n_words"] / lines,
    }
    return np.stack([found[name] for name in FEATURES], axis=1)


@dataclass
class Trees:
    """All nodes of all trees.  A leaf points at itself, so a walk may go on past it."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    offset: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The sum of each row's leaves: the log-odds of a good document."""
        row = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(DEPTH):
            goes_left = x[row, self.feature[node]] <= self.cut[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return self.offset + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -700, 700)))


class _Grower:
    """Grows one tree on binned rows; nodes go to the lists of the model."""

    def __init__(self, nodes: list[list], binned: np.ndarray, edges: list[np.ndarray], signs: np.ndarray):
        self.nodes, self.binned, self.edges, self.signs = nodes, binned, edges, signs

    def grow(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float, step: np.ndarray) -> int:
        """The node for ``rows``; leaves are written to ``step``."""
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + RIDGE), low, high))
        at = len(self.nodes)
        self.nodes.append([0, np.inf, at, at, RATE * value])
        split = self._best(rows, g, h, low, high) if depth else None
        if split is None:
            step[rows] = RATE * value
            return at
        feature, b, (lower, upper) = split
        middle = (lower + upper) / 2
        goes_left = self.binned[rows, feature] <= b
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        one, two = bounds[int(self.signs[feature])]
        left = self.grow(rows[goes_left], g, h, depth - 1, *one, step)
        right = self.grow(rows[~goes_left], g, h, depth - 1, *two, step)
        self.nodes[at] = [feature, float(self.edges[feature][b]), left, right, 0.0]
        return at

    def _best(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        """(feature, bin, values of both sides) of the split with the largest gain, or None."""
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best, most = None, 1e-6
        gain = lambda a, b, v: -(a * v + 0.5 * (b + RIDGE) * v * v)
        alone = gain(total_g, total_h, np.clip(-total_g / (total_h + RIDGE), low, high))
        for feature, edges in enumerate(self.edges):
            if not len(edges):
                continue
            bins = self.binned[rows, feature]
            left_g = np.cumsum(np.bincount(bins, weights=g[rows], minlength=len(edges) + 1))[:-1]
            left_h = np.cumsum(np.bincount(bins, weights=h[rows], minlength=len(edges) + 1))[:-1]
            left_n = np.cumsum(np.bincount(bins, minlength=len(edges) + 1))[:-1]
            lower = np.clip(-left_g / (left_h + RIDGE), low, high)
            upper = np.clip(-(total_g - left_g) / (total_h - left_h + RIDGE), low, high)
            gains = gain(left_g, left_h, lower) + gain(total_g - left_g, total_h - left_h, upper) - alone
            allowed = (left_n >= LEAST) & (len(rows) - left_n >= LEAST) & (self.signs[feature] * (upper - lower) >= 0)
            gains = np.where(allowed, gains, -np.inf)
            b = int(np.argmax(gains))
            if gains[b] > most:
                best, most = (feature, b, (float(lower[b]), float(upper[b]))), float(gains[b])
        return best


def boost(x: np.ndarray, good: np.ndarray, signs: np.ndarray, trees: int = TREES) -> Trees:
    """Fit on rows of features with labels (bool); both classes weigh the same."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
    # A cut at a column's largest value splits nothing.
    edges = [e[e < column.max()] for e, column in zip(edges, x.T)]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)], axis=1)
    weight = np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum())) * len(good)
    margin = np.zeros(len(x))
    nodes, roots, every = [], [], np.arange(len(x))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(x))
        grower = _Grower(nodes, binned, edges, signs)
        roots.append(grower.grow(every, weight * (p - good), weight * p * (1 - p), DEPTH, -4.0, 4.0, step))
        margin += step
    columns = list(zip(*nodes))
    kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
    return Trees(*[np.array(c, dtype=k) for c, k in zip(columns, kinds)], np.array(roots, np.int32), 0.0)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, columns COUNTS) for each row of docs."""
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                ids, texts = (batch.column(i).slice(first, last - first) for i in range(2))
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, statistics(texts_of(texts, lower=False)))], ["doc_id", *COUNTS])

    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(", ".join(f"{c} long" for c in COUNTS)).fields])
    return rows.mapInArrow(run, schema)


def labelled_sample(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Statistics and ``good`` of at most ``sample`` labelled documents of each class.

    A document with several labels is good only if all say so; of rows that repeat a doc_id any may be taken.
    """
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    rows = stage(measured.join(marked, "doc_id").select("doc_id", "good", *COUNTS), "labelled")
    order = F.xxhash64("doc_id", F.lit("quality"))
    parts = [rows.where(F.col("good") == F.lit(kind)).orderBy(order, "doc_id", *COUNTS).limit(sample) for kind in (True, False)]
    return parts[0].unionByName(parts[1]).drop("doc_id")


def fit(sample: DataFrame) -> Trees | None:
    """Trees fitted on a sample, which is of bounded size; None if it lacks a class."""
    rows = sample.toArrow()
    good = rows.column("good").to_numpy().astype(bool)
    if not good.any() or good.all():
        return None
    x = features({c: rows.column(c).to_numpy() for c in COUNTS})
    # The order in which rows arrive must not matter.
    order = np.lexsort((*x.T, good))
    return boost(x[order], good[order], np.array(list(FEATURES.values())))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the columns COUNTS, base_failed, score (0 to 1, higher: better) and kept, for each row of docs.

    ``docs``: doc_id and text; ``labels``: doc_id and quality; other columns are ignored.  Null and empty texts have no words
    and fail the base rules.  Rows that repeat an id are judged each by its own text; a null doc_id is judged but not
    fitted on.  ``kept`` needs the base rules and a score of at least 0.5; if the labels lack a class there are
    no trees, every score is 1 and the base rules decide alone.  The model is of fixed size and broadcast.
    """
    measured = stage(measure(docs), "statistics")
    shared = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(measured, labels, sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {c: batch.column(c).to_numpy() for c in COUNTS}
            scores = shared.value.score(features(counts)) if shared.value else np.ones(batch.num_rows)
            failed = (counts["n_words"] < FEWEST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(failed), pa.array(scores), pa.array(~failed & (scores >= 0.5))],
                ["doc_id", *COUNTS, "base_failed", "score", "kept"],
            )

    schema = StructType([*measured.schema.fields, *StructType.fromDDL("base_failed boolean, score double, kept boolean").fields])
    return measured.mapInArrow(run, schema)

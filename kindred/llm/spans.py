"""Words of whole Arrow batches, as positions and hashes.

The texts of a batch are joined with line feeds and walked in chunks of a few megabytes, so
memory does not grow with the batch.  A chunk ends where no phrase goes on: at a line feed, or at
another byte of ``breaks``.  Only a text without any of those makes a chunk longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kindred.llm.hashing import BASE, _LOWER, _power, mix

CHUNK = 4 << 20
_SEGMENT = 1 << 20


@dataclass
class Chunk:
    """Words of some texts: where they start and end in ``data``, their hashes, and their text's place in the batch."""

    data: bytes
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def word_spans(codes: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every run of word bytes; the hash is that of ``hashing.word_hashes``."""
    found, at = [], 0
    while at < len(codes):
        end = min(at + _SEGMENT, len(codes))
        while end < len(codes) and word_byte[codes[end]]:
            run = word_byte[codes[end:end + 4096]]
            end += len(run) if run.all() else int(run.argmin())
        part = codes[at:end]
        edges = np.zeros(len(part) + 2, dtype=bool)
        np.take(word_byte, part, out=edges[1:-1])
        changes = np.flatnonzero(edges[1:] != edges[:-1])
        starts, ends = changes[::2], changes[1::2]
        up, down = _power(len(part) + 1)
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(part * up[: len(part)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).view(np.uint64))
        found.append((starts + at, ends + at, hashes))
        at = end
    if len(found) == 1:
        return found[0]
    empty = np.empty(0, np.intp)
    return tuple(np.concatenate([f[i] for f in found] or [empty if i < 2 else empty.view(np.uint64)]) for i in range(3))


def texts_of(column: pa.Array, lower: bool) -> list[bytes]:
    """UTF-8 of each text, A-Z lower-cased on request; empty for null."""
    texts = column.cast(pa.binary()).to_pylist()
    return [b"" if t is None else t.translate(_LOWER) if lower else t for t in texts]


def slices(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text each."""
    ends = np.cumsum(np.array(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64) + 1)
    start = 0
    while start < len(ends):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right"))
        stop = max(start + 1, stop)
        yield start, stop
        start = stop


def chunks(column: pa.Array, word_byte: np.ndarray, breaks: np.ndarray, lower: bool = True, size: int = CHUNK) -> Iterator[Chunk]:
    """The words of a column of texts.  ``breaks`` marks the bytes at which a long text may be cut."""
    for first, last in slices(column, size):
        texts = texts_of(column.slice(first, last - first), lower)
        data = b"\n".join(texts)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        codes = np.frombuffer(data, dtype=np.uint8)
        at = 0
        while at < len(codes):
            end = _cut(codes, at, size, breaks)
            starts, ends, hashes = word_spans(codes[at:end], word_byte)
            rows = first + np.searchsorted(text_ends, starts + at, "right")
            yield Chunk(data[at:end], codes[at:end], starts, ends, hashes, rows)
            at = end


def _cut(codes: np.ndarray, at: int, size: int, breaks: np.ndarray) -> int:
    """The end of a chunk: after the last break within twice ``size`` bytes, or the first one after them."""
    end = at + 2 * size
    if end >= len(codes):
        return len(codes)
    places = np.flatnonzero(breaks[codes[at:end]])
    if len(places):
        return at + int(places[-1]) + 1
    while end < len(codes):
        places = np.flatnonzero(breaks[codes[end:end + size]])
        if len(places):
            return end + int(places[0]) + 1
        end += size
    return len(codes)


def runs(hashes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hashes of all runs of n words) for n from 1 to ``longest``."""
    found = mix(hashes + np.uint64(1))
    yield 1, found
    for n in range(2, longest + 1):
        count = max(0, len(hashes) - n + 1)
        found = mix(found[:count] * np.uint64(BASE) + hashes[n - 1:] + np.uint64(n))
        yield n, found

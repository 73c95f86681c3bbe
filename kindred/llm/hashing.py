"""Word hashes of whole texts, as numpy arrays.

A word's hash is a polynomial over its UTF-8 bytes modulo 2**64, mixed afterwards.  With
prefix sums of byte * BASE**position every word of a text costs one subtraction and one
multiplication by an inverse power.  Texts are walked in segments of about a megabyte that
end between words, so memory does not grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
SEGMENT = 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers: dict[str, np.ndarray] = {}


def byte_class(separators: bytes | range | list[int]) -> np.ndarray:
    """A table over byte values: True for bytes of words."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: ``[^\x20\x09-\x0D]+``: runs of anything but ASCII white space.
SPACED = byte_class([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: letters, digits and all beyond ASCII.
ALPHANUMERIC = byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased; none for null."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(_LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below ``size``."""
    if len(_powers.get("up", ())) < size:
        room = 1 << max(16, (size - 1).bit_length())
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(room, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _segments(data: bytes, word_byte: np.ndarray) -> Iterator[np.ndarray]:
    codes = np.frombuffer(data, dtype=np.uint8)
    start = 0
    while start < len(codes):
        end = min(start + SEGMENT, len(codes))
        while end < len(codes) and word_byte[codes[end]]:
            run = word_byte[codes[end:end + 4096]]
            end += len(run) if run.all() else int(run.argmin())
        yield codes[start:end]
        start = end


def word_hashes(data: bytes, word_byte: np.ndarray = SPACED) -> np.ndarray:
    """The hash of every word of ``data``, in order (uint64)."""
    found = [_hash_words(codes, word_byte)[1] for codes in _segments(data, word_byte)]
    return found[0] if len(found) == 1 else np.concatenate(found or [np.empty(0, np.uint64)])


def _hash_words(codes: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word."""
    edges = np.zeros(len(codes) + 2, dtype=bool)
    np.take(word_byte, codes, out=edges[1:-1])
    changes = np.flatnonzero(edges[1:] != edges[:-1])
    starts, ends = changes[::2], changes[1::2]
    up, down = _power(len(codes) + 1)
    sums = np.empty(len(codes) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).view(np.uint64))


def batch_words(texts: list[str | None], word_byte: np.ndarray = SPACED) -> Iterator[np.ndarray]:
    """The word hashes of each text.  Short texts are hashed together, long ones in segments."""
    waiting: list[bytes] = []
    size = 0
    for text in texts:
        data = lower_ascii(text)
        if waiting and size + len(data) > SEGMENT:
            yield from _together(waiting, word_byte)
            waiting, size = [], 0
        if len(data) > SEGMENT:
            yield word_hashes(data, word_byte)
        else:
            waiting.append(data)
            size += len(data) + 1
    yield from _together(waiting, word_byte)


def _together(texts: list[bytes], word_byte: np.ndarray) -> Iterator[np.ndarray]:
    if texts:
        starts, hashes = _hash_words(np.frombuffer(b" ".join(texts), dtype=np.uint8), word_byte)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    keep = np.empty(len(values), dtype=bool)
    keep[:1] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; of the whole sequence if it is shorter."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    runs = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        runs = mix(runs * np.uint64(BASE) + words[i: len(words) - size + 1 + i])
    return distinct(runs)

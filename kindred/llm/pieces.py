"""Encode texts piece by piece, each different piece once.

Byte-level vocabularies split a text by a pattern and never merge across pieces, so the
encoding of a text is the joined encodings of its pieces.  Pieces repeat: their encodings
are kept in a table of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import regex

MAX_KEPT = 64

#: Fixed value: the usual splitting pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same for texts of Latin letters, where the standard library's classes agree with the
# properties above but for the characters of _ODD; it is faster.
_LATIN = re.compile(r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_ODD = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]").search


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the pattern in a text."""
    general = regex.compile(pattern).findall
    if pattern != PATTERN:
        return general
    return lambda text: general(text) if _ODD(text) else _LATIN(text)


class PieceEncoder:
    """``learn`` maps a list of different pieces to a dict of their encodings (bytes)."""

    def __init__(self, pattern: str, learn: Callable[[list[str]], dict[str, bytes]], limit: int = 400_000):
        self.split = splitter(pattern)
        self._learn = learn
        self._limit = limit
        self._known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The encodings of several texts."""
        return self.encode_pieces([self.split(text) for text in texts])

    def encode_pieces(self, lists: list[list[str]]) -> list[bytes]:
        """The encodings of several texts that are split already."""
        met = set(chain.from_iterable(lists))
        new = met.difference(self._known)
        if len(self._known) + len(new) > self._limit:
            # What these texts use stays, so that frequent pieces are not learnt again.
            self._known = {piece: self._known[piece] for piece in met.difference(new)}
        self._known.update(self._learn(list(new)))
        find = self._known.__getitem__
        encoded = [find(pieces[0]) if len(pieces) == 1 else b"".join(map(find, pieces)) for pieces in lists]
        for piece in new:
            if len(piece) > MAX_KEPT:
                del self._known[piece]
        return encoded

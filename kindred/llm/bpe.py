"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes exactly if every two neighbours are
the encoding of their joint bytes, and every token that of its own.  So the merges compile
into a non-deterministic transducer: it walks the trie of token bytes, and may put out a
token at a trie node that spells it if the token before tolerates it as a neighbour.  For
every prefix of the input exactly one run ends there.

``Transducer`` determinises it while it reads.  A state is the set of runs that are still
alive, each with the tokens it has put out and the others have not agreed on.  As soon as
all runs agree on a token, the transition emits it: the lookahead is bounded by the longest
token.  States and transitions are made when a piece needs them the second time, and kept in
a table of bounded size; where the table has none, the runs are simulated.  Encodings of
whole pieces are kept in a table of bounded size as well.

``StreamDecoder`` turns token ids back into text as they come: a state machine over UTF-8
remembers how many continuation bytes are due and holds back unfinished characters.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.pieces import PieceEncoder

MAX_TRANSITIONS = 100_000
MAX_NEIGHBOURS = 300_000
BATCH_ROWS = 250
_ROOT = 0
_START = -1


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes, a blank and its rank, one token per line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


class Transducer:
    """Encode one piece (a match of the splitting pattern) at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self._child: dict[int, int] = {}
        self._token = [None]
        self._leaf = [False]
        for token, rank in ranks.items():
            node = _ROOT
            for byte in token:
                key = node << 8 | byte
                child = self._child.get(key)
                if child is None:
                    child = self._child[key] = len(self._token)
                    self._token.append(None)
                node = child
            self._token[node] = rank
        inner = {key >> 8 for key in self._child}
        self._leaf = [node not in inner for node in range(len(self._token))]
        self._neighbours: dict[int, bool] = {}
        self._spines: tuple[dict, dict] = ({}, {})
        start = (((_START,), _ROOT),)
        self._states = [start]
        self._number = {start: 0}
        self._next: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._met: set[int] = set()

    def merge(self, piece: bytes) -> list[int]:
        """The definition: merge the neighbours of least joint rank, the leftmost first."""
        parts = [piece[i: i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best: best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """The parts that end (or begin) a token while it is merged, from a byte to the whole,
        each with the rank of the merge that uses it up.  Empty if merges don't lead to the token."""
        spines = self._spines[right]
        if token not in spines:
            whole, steps = self.bytes_of[token], []
            parts = [whole[i: i + 1] for i in range(len(whole))]
            while len(parts) > 1:
                best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
                rank = self.ranks.get(parts[best] + parts[best + 1])
                if rank is None:
                    break
                edge = len(parts) - 2 if right else 0
                if best == edge:
                    steps.append((parts[-1] if right else parts[0], rank))
                parts[best: best + 2] = [parts[best] + parts[best + 1]]
            spines[token] = steps + [(whole, 1 << 60)] if len(parts) == 1 else []
        return spines[token]

    def _tolerates(self, before: int, token: int) -> bool:
        """Whether no merge across the border of the two tokens comes before the merges within.

        While the tokens are merged, the parts at the border grow along their spines.  A merge
        of both is preferred to one that uses up the left part if its rank is lower, and to
        one that uses up the right part also if it is equal: the leftmost goes first.
        """
        if before == _START:
            return bool(self._spine(token, False))
        known = self._neighbours.get(before << 32 | token)
        if known is None:
            if len(self._neighbours) >= MAX_NEIGHBOURS:
                self._neighbours.clear()
            left, right = self._spine(before, True), self._spine(token, False)
            i = j = 0
            known = bool(right)
            while known and i < len(left) and j < len(right):
                (x, x_used), (y, y_used) = left[i], right[j]
                rank = self.ranks.get(x + y)
                known = rank is None or rank >= x_used or rank > y_used
                i, j = (i + 1, j) if x_used <= y_used else (i, j + 1)
            self._neighbours[before << 32 | token] = known
        return known

    def _advance(self, runs, byte: int) -> list:
        """The runs that live after one more byte, the one that has just put out a token last."""
        alive, ended = [], None
        children, token_of, leaf, neighbours = self._child, self._token, self._leaf, self._neighbours
        for tokens, node in runs:
            child = children.get(node << 8 | byte)
            if child is None:
                continue
            if ended is None and (token := token_of[child]) is not None:
                fits = neighbours.get(tokens[-1] << 32 | token)
                if fits if fits is not None else self._tolerates(tokens[-1], token):
                    ended = tokens + (token,)
            if not leaf[child]:
                alive.append((tokens, child))
        alive.append((ended, _ROOT))
        return alive

    def _simulate(self, runs, rest: bytes) -> list[int]:
        """The tokens that the runs put out over the rest of a piece.

        Runs share what they have put out: each holds its last token and a link to what was
        before it, so a byte costs as many steps as runs are alive, however long the piece is.
        """
        linked = []
        for tokens, node in runs:
            link = None
            for token in tokens:
                link = (token, link)
            linked.append((link, node))
        children, token_of, leaf, neighbours = self._child, self._token, self._leaf, self._neighbours
        for byte in rest:
            alive, ended = [], None
            for link, node in linked:
                child = children.get(node << 8 | byte)
                if child is None:
                    continue
                if ended is None and (token := token_of[child]) is not None:
                    fits = neighbours.get(link[0] << 32 | token)
                    if fits if fits is not None else self._tolerates(link[0], token):
                        ended = token, link
                if not leaf[child]:
                    alive.append((link, child))
            alive.append((ended, _ROOT))
            linked = alive
        out, link = [], linked[-1][0]
        while link is not None:
            out.append(link[0])
            link = link[1]
        return out[-2::-1]

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the transition of ``state`` on ``byte``: runs that agree on tokens emit them."""
        alive = self._advance(self._states[state], byte)
        first = alive[0][0]
        agreed = 1
        while agreed < len(first) and all(len(t) > agreed and t[agreed] == first[agreed] for t, _ in alive):
            agreed += 1
        out = first[1:agreed]
        target = tuple([(t[agreed - 1:], node) for t, node in alive])
        number = self._number.get(target)
        if number is None:
            number = self._number[target] = len(self._states)
            self._states.append(target)
        self._next[state << 8 | byte] = number, out
        return number, out

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The ranks of a piece's tokens.  A piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        state, out = 0, []
        made_of = self._next.get
        for at, byte in enumerate(piece):
            key = state << 8 | byte
            made = made_of(key)
            if made is None:
                if key not in self._met or len(self._next) >= MAX_TRANSITIONS:
                    # A transition is worth keeping when it is met again; until then, and when
                    # the table is full, the runs themselves go through the rest of the piece.
                    if len(self._met) < 4 * MAX_TRANSITIONS:
                        self._met.add(key)
                    out += self._simulate(self._states[state], piece[at:])
                    return tuple(out)
                made = self._step(state, byte)
            state, emitted = made
            if emitted:
                out += emitted
        # The run that has just ended at the last byte is the last of the state.
        out += self._states[state][-1][0][1:]
        return tuple(out)


class Encoder:
    """Encode texts: split by the pattern, then run each different piece through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._transducer = Transducer(ranks)
        self._pieces = PieceEncoder(pattern, self._learn)

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        encode = self._transducer.encode
        tokens = [encode(piece.encode("utf-8")) for piece in pieces]
        data = np.fromiter(chain.from_iterable(tokens), dtype="<u4").tobytes()
        ends = [0, *accumulate(4 * len(t) for t in tokens)]
        return {piece: data[a:b] for piece, a, b in zip(pieces, ends, ends[1:])}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian uint32; none for null."""
        return self._pieces.encode([text or "" for text in texts])


class StreamDecoder:
    """Decode ids piece by piece; ``feed`` returns the characters that are complete.

    Bytes that can't be UTF-8 become U+FFFD, as at the end does an unfinished character.
    """

    def __init__(self, bytes_of: dict[int, bytes] | list[bytes]):
        self._bytes_of = bytes_of
        self._held = b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self._held + b"".join(map(self._bytes_of.__getitem__, ids))
        cut = len(data) - self._unfinished(data)
        self._held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self._held = self._held, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many last bytes begin a character whose other bytes are due."""
        due = size = 0
        for byte in data[-3:]:
            if byte & 0xC0 == 0x80 and due:
                due, size = due - 1, size + 1
            else:
                due = 1 * (0xC2 <= byte < 0xE0) + 2 * (0xE0 <= byte < 0xF0) + 3 * (0xF0 <= byte < 0xF5)
                size = 1
        return size if due else 0


@lru_cache(maxsize=2)
def _encoder(content: bytes, pattern: str) -> Encoder:
    return Encoder(parse_ranks(content), pattern)


def _vocabulary_bytes(df: DataFrame, path: str):
    """The rank file, sent once to each executor: a vocabulary's size is fixed, about a megabyte."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def transcode(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens",
    decoded: str | None = None, keep: list[str] | None = None, block: int = 4096,
) -> DataFrame:
    """Add the token ids of a text column: binary (little-endian uint32) and their number.

    With ``decoded``, that column gets the text decoded from the ids, ``block`` ids at a time.
    Null and empty texts have no ids.  ``keep`` names the columns that stay (default: all);
    columns with the names of the new ones are replaced.
    """
    content = _vocabulary_bytes(df, ranks_path)
    made = [ids, n_tokens] + ([decoded] if decoded else [])
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bytes_of = _encoder(content.value, pattern), _tokens(content.value)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                found = encoder.encode(part.column(part.num_columns - 1).to_pylist())
                columns = part.columns[:-1] + [pa.array(found, pa.binary()), pa.array([len(x) // 4 for x in found], pa.int64())]
                if decoded:
                    columns.append(pa.array([decode_ids(x, bytes_of, block) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, keep + made)

    types = [f"`{ids}` binary", f"`{n_tokens}` long"] + ([f"`{decoded}` string"] if decoded else [])
    return rows.mapInArrow(run, _extended(df.select(*[f"`{c}`" for c in keep]), ", ".join(types)))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded", block: int = 4096) -> DataFrame:
    """Add the text of a column of ids (binary, little-endian uint32; null: empty)."""
    content = _vocabulary_bytes(df, ranks_path)
    kept = [c for c in df.columns if c != decoded]
    df = df.select(*[f"`{c}`" for c in kept])
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = _tokens(content.value)
        for batch in batches:
            texts = [decode_ids(v.as_py() or b"", bytes_of, block) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], kept + [decoded])

    return df.mapInArrow(run, _extended(df, f"`{decoded}` string"))


def decode_ids(ids: bytes, bytes_of: dict[int, bytes], block: int) -> str:
    """Decode little-endian uint32 ids, ``block`` at a time."""
    decoder = StreamDecoder(bytes_of)
    tokens = np.frombuffer(ids, dtype="<u4").tolist()
    parts = [decoder.feed(tokens[i: i + block]) for i in range(0, len(tokens), block)]
    return "".join(parts) + decoder.close()


@lru_cache(maxsize=2)
def _tokens(content: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in parse_ranks(content).items()}


def _extended(df: DataFrame, more: str):
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])

"""Token sequences in length-delimited binary files with an offset index.

A record is::

    uint64 length | uint32 masked checksum of the length | payload | uint32 masked checksum of the payload | 0x0A

all little-endian.  The payload is an int64 document id and the token ids (uint16, or uint32
for vocabularies over 65,536).  A masked checksum is crc32 rotated right by 15 bits plus
0xA282EAD8, so that a checksum stored inside checksummed data does not stand out.  Files are
written in ascending document order by Spark's own writer, with its commit protocol: a record
is handed over as the bytes of one line, so that any file system Spark knows will do and a
lost task leaves nothing behind.

Files are cut by bytes: running sums over (doc_id, hash of the text) say where each begins, so
long documents, or many rows of one document, do not make one file large.

The index is a separate table: document, file, offset, length, number of tokens and the
number of ids before it.  ``read_at`` fetches records by index rows, in any order;
``read_all`` walks whole files and needs one number for each file.
"""

from __future__ import annotations

import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.llm.pieces import PATTERN, PieceEncoder
from kindred.sources.staging import stage

#: Text of a file; larger where there would be more than MAX_FILES files.
FILE_BYTES = 16 << 20
MAX_FILES = 1 << 20
BATCH_ROWS = 250
#: Text that is encoded at once: the more, the fewer of its chunks are different ones.
BATCH_BYTES = 4 << 20
# So many new pieces go to the library at a time, which keeps much about each token until it is done.
LEARNT = 4096
_HEAD = struct.Struct("<QI")
_SUM = struct.Struct("<I")
_ID = struct.Struct("<q")
_ID_BYTES = _ID.size
_OVERHEAD = _HEAD.size + _SUM.size + 1


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return _HEAD.pack(len(payload), masked(length)) + payload + _SUM.pack(masked(payload)) + b"\n"


def unframe(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each record; ValueError where a checksum or a length is wrong."""
    at = 0
    while at < len(data):
        if at + _HEAD.size > len(data):
            raise ValueError(f"record cut off at byte {at}")
        size, check = _HEAD.unpack_from(data, at)
        if masked(bytes(data[at: at + 8])) != check:
            raise ValueError(f"wrong checksum of a length at byte {at}")
        payload = data[at + _HEAD.size: at + _HEAD.size + size]
        end = at + _OVERHEAD + size
        if end > len(data) or masked(payload) != _SUM.unpack_from(data, end - 5)[0] or data[end - 1] != 10:
            raise ValueError(f"wrong checksum of a record at byte {at}")
        yield at, payload
        at = end


def document_of(payload: memoryview) -> int:
    return _ID.unpack_from(payload)[0]


_LETTERS, _PUNCTUATION = "[A-Za-zÀ-ÖØ-öø-ɏ]", "[!-/:-@\\[-`{-~]"


class LibraryEncoder:
    """Encode texts with the tokenizers library, each different piece once.

    Arrow cuts texts before each blank, where a piece begins unless the blank is inside white space, and puts their ids
    together from those of the different chunks, so only these are split into pieces.  Texts with a blank that has white
    space on both sides, or white space before it and nothing after it, are split whole.

    New pieces without white space inside go to the library together, on lines of their own:
    a line feed between two such pieces is a piece and one token.  All others, and texts that name a
    special token, are handed to the library by themselves.
    """

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_buffer(content)
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._feed = self._ids("\n")
        self._pieces = PieceEncoder(PATTERN, self._learn)

    def _ids(self, text: str) -> list[int]:
        return self._library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """uint32 ids of each text."""
        special = np.zeros(len(texts), bool)
        for content in self._special:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.if_else(pa.array(special), "", texts), " ")
        starts = cut.offsets.to_numpy().astype(np.int64)
        chunks = cut.flatten().dictionary_encode()
        which, names = chunks.indices.to_numpy(), chunks.dictionary
        flags = lambda x: x.to_numpy(zero_copy_only=False)
        # Latin letters are a piece, with a blank or without; punctuation at their end is one more.
        letters, ended = (flags(pc.match_substring_regex(names, f"^{_LETTERS}+{end}$")) for end in ("", f"{_PUNCTUATION}+"))
        kind = np.where(letters, 1, np.where(ended, 2, 0))
        empty = flags(pc.equal(names, ""))
        before = empty | flags(pc.utf8_is_space(pc.utf8_slice_codeunits(names, -1)))
        after = empty | flags(pc.utf8_is_space(pc.utf8_slice_codeunits(names, 0, 1)))
        names = flags(names)
        first = np.zeros(len(which), bool)
        first[starts[:-1]] = True
        # Nothing is before a blank at the start of a text.
        unsure = before[which[:-1]] & ~(first[:-1] & empty[which[:-1]]) & after[which[1:]] & ~first[1:]
        whole = np.zeros(len(texts), bool)
        whole[np.searchsorted(starts, np.flatnonzero(unsure), side="right") - 1] = True

        # All chunks but a text's first begin with their blank.
        code = which + np.int32(len(names)) * first
        kept = ~np.repeat(whole, np.diff(starts))
        used = np.flatnonzero(np.bincount(code[kept], minlength=2 * len(names)))
        name, blank = used % max(1, len(names)), used < len(names)
        keys = [" " + c if b else c for c, b in zip(names[name].tolist(), blank.tolist())]
        split = self._pieces.split
        lists = [
            [key] if k == 1 else [word := key.rstrip(string.punctuation), key[len(word):]] if k else split(key)
            for key, k in zip(keys, kind[name].tolist())
        ]
        lists += [[], *map(split, texts.filter(pa.array(whole)).to_pylist())]
        place = np.zeros(2 * len(names), np.int32)
        place[used] = np.arange(len(used))
        place = np.where(kept, place[code], np.int32(len(used)))
        place[starts[:-1][whole]] = len(used) + 1 + np.arange(np.count_nonzero(whole))
        found = self._pieces.encode_pieces(lists)
        joined = pa.array(found, pa.large_binary()).take(pa.array(place))
        ends, ids = np.frombuffer(joined.buffers()[1], np.int64)[starts] // 4, np.frombuffer(joined.buffers()[2], "<u4")
        return [
            np.array(self._ids(texts[row].as_py()), dtype=np.uint32) if own else ids[ends[row]: ends[row + 1]]
            for row, own in enumerate(special.tolist())
        ]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        spaces = [p for p in pieces if p.isspace()]
        words = [p for p in pieces if not p.isspace()] if spaces else pieces
        known: dict[str, bytes] = {}
        for start in range(0, len(words) if len(self._feed) == 1 else 0, LEARNT):
            some = words[start: start + LEARNT]
            ids = np.array(self._ids("\n".join(some)), dtype="<u4")
            cuts = 4 * np.flatnonzero(ids == self._feed[0])
            if len(cuts) == len(some) - 1:
                data, ends = ids.tobytes(), cuts.tolist()
                known.update((w, data[a:b]) for w, a, b in zip(some, [0, *(cuts + 4).tolist()], [*ends, len(data)]))
        for piece in pieces if len(known) < len(words) else spaces:
            known[piece] = np.array(self._ids(piece), dtype="<u4").tobytes()
        return known


@lru_cache(maxsize=2)
def _encoder(content: bytes) -> LibraryEncoder:
    return LibraryEncoder(content)


def _payload(doc_id: int | None, ids: np.ndarray, width: str) -> bytes:
    return _ID.pack(-(1 << 63) if doc_id is None else doc_id) + ids.astype(width).tobytes()


_KEY = np.dtype([("doc_id", "<i8"), ("text_hash", "<i8")])


def _keys(rows: DataFrame) -> DataFrame:
    """``doc_id`` without null, and the hash of the text: the order in which rows go to files."""
    return rows.withColumns({"key_id": F.coalesce("doc_id", F.lit(-(1 << 63))), "key_hash": F.xxhash64("text")})


def _cuts(rows: DataFrame, file_bytes: int) -> np.ndarray:
    """First keys of the files but the first, as often as files begin within the rows of a key.

    Bytes are summed by key; a key's place among all bytes is its place in its range of keys
    plus the bytes of lower ranges.  The driver gets a sum for each range and a key for each
    file, at most MAX_FILES keys of 16 bytes.
    """
    spark = rows.sparkSession
    sized = _keys(rows).groupBy("key_id", "key_hash").agg(F.sum(F.octet_length("text").cast("long") + 32).alias("size"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = stage(sized.repartitionByRange(ranges, "key_id", "key_hash").withColumn("part", F.spark_partition_id()), "record-sizes")
    sums = {r["part"]: r["size"] for r in ranged.groupBy("part").agg(F.sum("size").alias("size")).collect()}
    total, lower = 0, []
    for part in sorted(sums):
        lower.append((part, total))
        total += sums[part]
    if not lower:
        return np.empty(0, _KEY)
    file_bytes = max(file_bytes, -(-total // MAX_FILES))
    before = F.element_at(F.create_map(*[F.lit(x) for pair in lower for x in pair]), F.col("part"))
    inside = Window.partitionBy("part").orderBy("key_id", "key_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = (before + F.sum("size").over(inside)).cast("long")
    placed = ranged.select("key_id", "key_hash", upto.alias("upto"), (upto - F.col("size")).alias("from"))
    # File f begins with the first key that reaches beyond f * file_bytes.
    begun = lambda c: F.expr(f"({c} + {file_bytes} - 1) div {file_bytes}")
    placed = placed.select("key_id", "key_hash", (begun("upto") - F.greatest(begun("`from`"), F.lit(1))).cast("int").alias("files"))
    found = placed.where("files > 0").select("key_id", "key_hash", "files").toArrow()
    cuts = np.empty(found.num_rows, _KEY)
    cuts["doc_id"], cuts["text_hash"] = found.column(0).to_numpy(), found.column(1).to_numpy()
    return np.sort(np.repeat(cuts, found.column(2).to_numpy()), order=("doc_id", "text_hash"))


def _dealt(rows: DataFrame, cuts: np.ndarray) -> DataFrame:
    """Add ``file``: how many cuts are at or below the row's key; rows of a key with several cuts by turns."""
    shared = rows.sparkSession.sparkContext.broadcast(cuts)

    @F.arrow_udf("int")
    def file_of(key_id: pa.Array, key_hash: pa.Array, turn: pa.Array) -> pa.Array:
        keys = np.empty(len(key_id), _KEY)
        keys["doc_id"], keys["text_hash"] = key_id.to_numpy(), key_hash.to_numpy()
        below, last = (np.searchsorted(shared.value, keys, side) for side in ("left", "right"))
        first = np.minimum(below + 1, last)  # a key with a cut begins a file
        return pa.array((first + turn.to_numpy() % (last - first + 1)).astype(np.int32))

    keyed = _keys(rows).withColumn("turn", F.monotonically_increasing_id())
    return keyed.select("doc_id", "text", file_of("key_id", "key_hash", "turn").alias("file"))


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, wide: bool = False, file_bytes: int = FILE_BYTES) -> None:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, and write record files.

    Rows are dealt to files of about ``file_bytes`` of text (at most twice that and the largest text)
    by ranges of doc_id and sorted, so that files and records ascend; rows of one doc_id may be
    divided by their texts' hashes, and those of one file are ordered by their text.  Equal rows may go to
    any of the files that they fill.  A null text is empty; a null doc_id comes
    first and is stored as the smallest int64, which is read as null.
    """
    with open(tokenizer_path, "rb") as file:  # a vocabulary: a megabyte or two, whatever the input
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = _cuts(rows, file_bytes)
    rows = _dealt(rows, cuts).repartitionById(len(cuts) + 1, F.col("file")).drop("file").sortWithinPartitions("doc_id", "text")
    width = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for batch in batches:
            upto = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64) // BATCH_BYTES
            starts = np.flatnonzero(np.diff(upto, prepend=-1)).tolist()
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(start, end - start)
                lines = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1))):
                    ids = np.append(ids, np.uint32(end_id))
                    if not wide and int(ids.max()) > 0xFFFF:
                        raise ValueError("the vocabulary needs wide=True")
                    # The line feed at the end is the writer's.
                    lines.append(frame(_payload(doc_id, ids, width))[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["value"])

    framed = rows.mapInArrow(run, "value binary")
    framed.select(F.col("value").cast("string")).write.text(path, lineSep="\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content"
    )


_RECORD = "file string, doc_id long, offset long, length long, n_tokens long, start long"
_START = "file string, before long"


def build_index(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """A row for each record of the files under ``path``: file, doc_id, offset and length of
    the whole record, n_tokens, and start: the ids of all records before it."""
    width = 4 if wide else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, start = [], 0
                for at, payload in unframe(memoryview(content.as_buffer())):
                    n = (len(payload) - 8) // width
                    rows.append((document_of(payload), at, len(payload) + _OVERHEAD, n, start))
                    start += n
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * len(rows), pa.string()), *[pa.array(c, pa.int64()) for c in columns]],
                    ["file", "doc_id", "offset", "length", "n_tokens", "start"],
                )

    records = _files(spark, path).mapInArrow(run, _RECORD)
    null_id = F.col("doc_id") == F.lit(-(1 << 63))
    return records.withColumn("doc_id", F.when(~null_id, F.col("doc_id")))


def write_index(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """Write the offset index beside the files (``_index``, and the ids before each file in
    ``_starts``; readers of the files skip both).

    Within a file the starts are known when it is walked; a window over one row per file adds
    what the files before it hold.
    """
    build_index(spark, path, wide).write.parquet(f"{path}/_records")
    records = spark.read.schema(_RECORD).parquet(f"{path}/_records")
    files = records.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    files.write.parquet(f"{path}/_starts")
    index = records.join(spark.read.schema(_START).parquet(f"{path}/_starts"), "file")
    index = index.select("file", "doc_id", "offset", "length", "n_tokens", (F.col("start") + F.col("before")).alias("start"))
    index.write.parquet(f"{path}/_index")
    return spark.read.schema(_RECORD).parquet(f"{path}/_index")


def read_all(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """All records under ``path``, which has an index: doc_id, n_tokens, start, file and ``ids`` (binary, little-endian uint32).

    Files are walked where they are read; the table of their starts has a row for each file, and its
    size on disk tells Spark how to join it.
    """
    source = "<u4" if wide else "<u2"
    schema = "doc_id long, n_tokens long, start long, file string, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, start in zip(*(batch.column(i) for i in range(3))):
                start, rows = start.as_py(), []
                for _, payload in unframe(memoryview(content.as_buffer())):
                    ids = np.frombuffer(payload[_ID_BYTES:], dtype=source).astype("<u4")
                    rows.append((document_of(payload), len(ids), start, name.as_py(), ids.tobytes()))
                    start += len(ids)
                    if len(rows) == BATCH_ROWS:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n_tokens", "start", "file", "ids"])

    starts = spark.read.schema(_START).parquet(f"{path}/_starts")
    read = _files(spark, path).join(starts, "file").select("file", "content", "before").mapInArrow(run, schema)
    return read.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))


def read_at(spark: SparkSession, path: str, index: DataFrame, wide: bool = False) -> DataFrame:
    """The records that ``index`` names: its columns and ``ids`` (binary, little-endian uint32).

    Entries of one file meet its content once; a file is of bounded size, and so are its entries.
    """
    width = "<u4" if wide else "<u2"
    names = ["doc_id", "offset", "length", "n_tokens", "start"]
    wanted = index.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("offset", *[n for n in names if n != "offset"]))).alias("entries"))
    schema = "doc_id long, n_tokens long, start long, file string, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, entries in zip(*(batch.column(i) for i in range(3))):
                data, entries = memoryview(content.as_buffer()), entries.as_py()
                ids = []
                for e in entries:
                    _, payload = next(unframe(data[e["offset"]: e["offset"] + e["length"]]))
                    ids.append(np.frombuffer(payload[8:], dtype=width).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([
                    *[pa.array([e[c] for e in entries], pa.int64()) for c in ("doc_id", "n_tokens", "start")],
                    pa.array([name.as_py()] * len(entries), pa.string()), pa.array(ids, pa.binary()),
                ], ["doc_id", "n_tokens", "start", "file", "ids"])

    joined = _files(spark, path).join(wanted, "file").select("file", "content", "entries")
    return joined.mapInArrow(run, schema)


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index in a seeded random order, for shuffled reads."""
    order: Column = F.xxhash64("file", "offset", F.lit(seed))
    return index.orderBy(order, "file", "offset")

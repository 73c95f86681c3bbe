"""Transducer, decoder, piece tables, record files: against the libraries and round trips."""

import base64
import hashlib
import random
import struct
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import bpe, records

RANKS = public.path("byte_bpe_50k.tiktoken")
LIBRARY = public.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a", "a ", "\n a", "a\n b", "a\n \nb", " 's 's", "don't we'll", "x" * 500, " " * 300, "é È ñ ß 漢字 😀", "\x00\x1c\x85\xa0 b",
    "<|endoftext|>", "a <|endoftext|> b", "a" * 3000, "\n" * 200 + "x", "ab" * 400,
]
ROWS = [(i, t, "en") for i, t in enumerate(ODD)] + [(3, "again", "en"), (3, "again", "en"), (None, "no id", None), (99, None, "en")]
SCHEMA = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return bpe.parse_ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, public.PATTERN)


def noise(seed, count):
    rnd = random.Random(seed)
    pool = [chr(c) for c in [*range(0, 0x250), *range(0x370, 0x400), *range(0x2000, 0x2070), *range(0x3040, 0x3100), *range(0x1F600, 0x1F640)]]
    return ["".join(rnd.choice(pool) if rnd.random() < 0.3 else rnd.choice(" \n\tab'sreTHE  0123 llve") for _ in range(rnd.randrange(60))) for _ in range(count)]


def test_encoding_equals_the_library(encoder, reference):
    texts = ODD + noise(1, 400)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_small_tables_change_nothing(ranks, reference, monkeypatch):
    for name in ("MAX_TRANSITIONS", "MAX_NEIGHBOURS"):
        monkeypatch.setattr(bpe, name, 20)
    small = bpe.Encoder(ranks, public.PATTERN)
    small._pieces._limit = 10
    texts = noise(2, 150)
    for text, ids in zip(texts, small.encode(texts[:70]) + small.encode(texts[70:])):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize("piece", ["x", "the", "qzjw", "漢字仮名交じり文", " ", "-", "=*", "\n"])
def test_a_long_piece_takes_time_in_proportion(encoder, reference, piece):
    text = (piece * (1_000_000 // len(piece.encode())))[:1_000_000]
    rnd = random.Random(len(piece))
    mixed = "".join(rnd.choice("etaoinshrdlucmfwypvbgkjqxz") for _ in range(100_000))
    began = time.process_time()
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode([text, mixed])]
    assert time.process_time() - began < 100
    # Each text is one piece; the library's own splitting gives up on a million blanks.
    assert got == [reference._encode_single_piece(x) for x in (text, mixed)]


def test_transducer_equals_the_definition():
    """A small vocabulary with unreachable tokens and merges across several borders."""
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"cd", b"abcd", b"aa", b"aaa", b"ba", b"dab"]
    machine = bpe.Transducer({t: i for i, t in enumerate(tokens)})
    rnd = random.Random(5)
    for _ in range(3000):
        piece = bytes(rnd.choice(b"abcd") for _ in range(rnd.randrange(1, 14)))
        expected = [machine.ranks[piece]] if piece in machine.ranks else machine.merge(piece)
        assert list(machine.encode(piece)) == expected


def test_a_vocabulary_must_have_all_bytes():
    with pytest.raises(ValueError):
        bpe.Transducer({b"a": 0})


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40), st.integers(1, 5))
def test_streaming_decode_holds_back_unfinished_characters(text, block):
    data = text.encode("utf-8", "surrogatepass").decode("utf-8", "replace").encode()
    assert bpe.decode_ids(np.frombuffer(data, np.uint8).astype("<u4").tobytes(), {b: bytes([b]) for b in range(256)}, block) == data.decode()


def test_stream_decoder_replaces_what_is_not_utf8():
    decoder = bpe.StreamDecoder({i: bytes([i]) for i in range(256)})
    assert decoder.feed([0xE2, 0x82]) == "" and decoder.feed([0xAC]) == "€"
    assert decoder.feed([0xF0, 0x9F]) == "" and decoder.close() == "�"


def test_transcode_keeps_columns_and_replaces_clashes(spark, reference):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = bpe.transcode(df, RANKS, public.PATTERN, decoded="decoded")
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    for row in out.collect():
        expected = reference.encode_ordinary(row.text or "")
        assert np.frombuffer(row.ids, "<u4").tolist() == expected and row.n_tokens == len(expected)
        assert row.decoded == (row.text or "")
    assert bpe.decode(out.drop("decoded"), RANKS).where("decoded <> coalesce(text, '')").count() == 0
    assert bpe.transcode(df.limit(0), RANKS, public.PATTERN).count() == 0


def test_records_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS + [(1000 + i, t, "x") for i, t in enumerate(noise(3, 120))], SCHEMA)
    path = str(tmp_path / "records")
    records.write(df, path, LIBRARY)
    index = records.write_index(spark, path)
    back = sorted(records.read_at(spark, path, index).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(LIBRARY)
    expected = {}
    for r in df.collect():
        expected.setdefault(r.doc_id, []).append(library.encode(r.text or "", add_special_tokens=False).ids + [0])
    start = 0
    for r in back:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        expected[r.doc_id].remove(ids)
        assert r.n_tokens == len(ids) and r.start == start
        start += len(ids)
    assert not any(expected.values())
    known = [r.doc_id for r in back if r.doc_id is not None]
    assert known == sorted(known) and back[0].doc_id is None
    fields = ["doc_id", "n_tokens", "start", "file", "ids"]
    assert {tuple(r) for r in records.read_all(spark, path).select(fields).collect()} == {tuple(r[f] for f in fields) for r in back}
    some = index.where("doc_id % 7 = 3")
    assert records.read_at(spark, path, some).count() == some.count()
    order = [r.doc_id for r in records.shuffled(index, 1).collect()]
    assert order == [r.doc_id for r in records.shuffled(index, 1).collect()] and order != known


def test_small_files_ascend(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i} " * (i % 9), "x") for i in range(400)], SCHEMA)
    records.write(df, str(tmp_path / "r"), LIBRARY, file_bytes=2000)
    index = records.write_index(spark, str(tmp_path / "r"))
    assert index.select("file").distinct().count() > 3
    assert [r.doc_id for r in index.orderBy("start").collect()] == list(range(400))


def test_files_are_even_in_bytes(spark, tmp_path):
    """Few long texts at the end, one longer than a file, and a row that repeats over more than a file."""
    rows = [(i, "w " * 4, "x") for i in range(1000)] + [(2000 + i, f"long {i} " * 100, "x") for i in range(50)]
    rows += [(1500, "again " * 20, "x")] * 300 + [(1600, "x" * 30_000, "x"), (None, None, "x"), (-(1 << 63), "least", "x")]
    df, path, limit = spark.createDataFrame(rows, SCHEMA).repartition(5), str(tmp_path / "r"), 10_000
    records.write(df, path, LIBRARY, file_bytes=limit)
    index = records.write_index(spark, path)
    texts = index.join(df.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"), F.octet_length("text").alias("b")).distinct(), F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("i"))
    sizes = {r.file: (r.s, r.m) for r in texts.groupBy("file").agg(F.sum(F.coalesce("b", F.lit(0)) + 32).alias("s"), F.max("b").alias("m")).collect()}
    assert max(s for s, m in sizes.values() if m < limit) <= 1.5 * limit and len(sizes) >= 10
    back = records.read_all(spark, path).orderBy("start").collect()
    # The smallest id stands for null, and is read as null.
    order = [r.doc_id for r in back]
    assert len(back) == len(rows) and order == sorted(order, key=lambda i: -(1 << 63) if i is None else i) and order.count(None) == 2
    assert [r.start for r in back] == np.cumsum([0, *[r.n_tokens for r in back]])[:-1].tolist()


def test_empty_table_has_no_records(spark, tmp_path):
    records.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "r"), LIBRARY)
    index = records.write_index(spark, str(tmp_path / "r"))
    assert records.read_all(spark, str(tmp_path / "r")).count() == 0
    assert index.count() == 0 and records.read_at(spark, str(tmp_path / "r"), index).count() == 0


ODD = ["", " ", "  ", "a ", "a  ", "  b", "a  b", "a   b", "\n \nb", "a\n b", "a \nb", "a\u00a0 b", "x's 's", "b,, c$$ é! ², _ 1.", "<|endoftext|> a  b"]


def test_only_different_chunks_are_split(monkeypatch):
    """Texts that share their words are split by different chunks; those with blanks inside white space by themselves."""
    with open(public.path("byte_bpe_50k.json"), "rb") as file:
        content = file.read()
    monkeypatch.setattr(records, "LEARNT", 50)
    encoder, library = records.LibraryEncoder(content), Tokenizer.from_buffer(content)
    rng, split, asked = random.Random(3), [], []
    whole, ids = encoder._pieces.split, encoder._ids
    monkeypatch.setattr(encoder._pieces, "split", lambda text: split.append(text) or whole(text))
    monkeypatch.setattr(encoder, "_ids", lambda text: asked.append(text.count("\n")) or ids(text))
    words = [f"w{n}x" for n in range(300)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(100)]
    found = encoder.encode(pa.array(texts))
    assert [x.tolist() for x in found] == [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert len(split) <= 2 * len(words) and max(asked) < 50
    mixed = ODD + ["".join(rng.choices([" ", "\n", "\t", "a", "é", ".", "'", "1", "\u3000"], k=12)) for _ in range(500)]
    for part in (pa.array(mixed), pa.array(mixed).slice(3, 40), pa.array([], pa.string())):
        expected = [e.ids for e in library.encode_batch_fast(part.to_pylist(), add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(part)] == expected


def test_damage_is_noticed():
    data = records.frame(b"12345678payload") + records.frame(b"12345678")
    assert [bytes(p) for _, p in records.unframe(memoryview(data))] == [b"12345678payload", b"12345678"]
    for at in (0, 9, 15, len(data) - 2):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(memoryview(bytes(broken))))
    with pytest.raises(ValueError):
        list(records.unframe(memoryview(data[:-3])))


def test_query_digests(spark, reference, tmp_path):
    from kindred.llm.queries import op7_records, op9_bpe

    spark.createDataFrame(ROWS, SCHEMA).where("doc_id is not null").dropDuplicates(["doc_id"]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()}
    library = Tokenizer.from_file(LIBRARY)
    found, start = {r.doc_id: r for r in op7_records(spark, str(tmp_path)).collect()}, 0
    for doc_id in sorted(rows):
        ids = library.encode(rows[doc_id], add_special_tokens=False).ids + [0]
        assert found[doc_id][1:] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    for r in op9_bpe(spark, str(tmp_path)).collect():
        ids = reference.encode_ordinary(rows[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest() and r.n_tokens == len(ids)


def test_ranks_parse():
    assert bpe.parse_ranks(base64.b64encode(b"ab") + b" 7\n") == {b"ab": 7}

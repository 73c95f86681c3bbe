"""Near-duplicates against brute force over planted copies, and the edge cases."""

import re

import numpy as np
import pytest

from kindred.llm import minhash
from kindred.llm.hashing import batch_words, lower_ascii, shingles, word_hashes, SPACED

SCHEMA = "doc_id long, text string, lang string, n_shingles int"


def sets_of(text, words):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = [t for t in re.split(r"[\x20\x09-\x0D]+", text) if t]
    if not tokens:
        return set()
    size = min(words, len(tokens))
    return {tuple(tokens[i: i + size]) for i in range(len(tokens) - size + 1)}


def brute(rows, words, percent):
    sets = [sets_of(r[1], words) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and bool(a) and bool(sets[j])
            linked = a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j])
            if same or (linked and rows[i][0] is not None and rows[j][0] is not None):
                root[find(i)] = find(j)
    smallest = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            smallest[find(i)] = min(smallest.get(find(i), row[0]), row[0])
    return sorted(
        ((r[0], len(sets[i]), smallest[find(i)] if r[0] is not None else None) for i, r in enumerate(rows)),
        key=str,
    )


def planted(seed, groups=12, copies=14):
    rng = np.random.default_rng(seed)
    rows, doc = [], 0
    for _ in range(groups):
        base = [f"w{rng.integers(0, 400)}" for _ in range(int(rng.integers(5, 160)))]
        for _ in range(copies):
            words = [w if rng.random() > rng.choice([0, 0.01, 0.03, 0.08]) else f"x{rng.integers(0, 10**6)}" for w in base]
            rows.append((doc, ("  " if doc % 2 else "\n").join(words).upper() if doc % 3 else " ".join(words), "en", 1))
            doc += 1
    rng.shuffle(rows)
    return [(int(r[0]), r[1], "en", 1) for r in rows]


def check(spark, rows, words=3, percent=85):
    out = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), words, percent).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)
    assert got == brute(rows, words, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in out)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    check(spark, planted(seed))


def test_without_pivots_and_with_tiny_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PIVOTS", 1)
    monkeypatch.setattr(minhash, "TILE", 4)
    check(spark, planted(3))


def test_pivots_meet_communities_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART", 3)
    check(spark, planted(4, groups=5, copies=25))


@pytest.mark.parametrize("bits", [28, 3])
def test_the_map_of_wanted_texts_lets_them_pass(spark, monkeypatch, bits):
    monkeypatch.setattr(minhash, "MAP_BITS", bits)
    texts = spark.range(20_000).selectExpr("id node", "xxhash64(id) text_hash", "'x' text")
    wanted = texts.where("node % 97 = 5").select("node", "text_hash")
    passed = {r.node for r in minhash._perhaps(texts, wanted).collect()}
    assert passed >= {i for i in range(20_000) if i % 97 == 5}
    assert len(passed) < 1_000 if bits == 28 else len(passed) == 20_000
    assert minhash._perhaps(texts, wanted.limit(0)).count() == 0


def test_tiles_are_spread_by_all_their_keys(spark, capsys):
    members = spark.createDataFrame([(i, 3, 1, i % 2) for i in range(9)], "node long, n long, community long, label long")
    sets = spark.createDataFrame([(i, bytes(24)) for i in range(9)], "node long, members binary")
    tiles = minhash._tiles(members, sets, 80)
    tiles.explain()
    assert re.search(r"Exchange hashpartitioning\(community#\d+L?, r#\d+, c#\d+, m#\d+", capsys.readouterr().out)
    assert {frozenset((r.a % 2, r.b % 2)) for r in tiles.collect()} == {frozenset((0, 1))}


def test_nulls_blanks_ties_and_repeats(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [
        (1, None, None, None), (2, "", "en", 1), (3, " \t\n\x0b\x0c\r", "en", 1), (4, "one", "en", 1), (5, "ONE", None, 1),
        (6, "one two", "en", 1), (7, "a b c d", "en", 1), (7, "a b c d", "en", 1), (8, "a b c d", "en", 1),
        (9, long, "en", 1), (10, long + " end", "en", 1), (None, "one", "en", 1), (9, "other text of nine", "en", 1),
        (11, "Other TEXT of nine", "en", 1), (12, "É È", "en", 1), (13, "é è", "en", 1),
    ]
    check(spark, rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_segments_and_batches_hash_alike(monkeypatch):
    from kindred.llm import hashing

    text = "Alpha beta  gamma " * 50 + "x" * 3000
    whole = word_hashes(lower_ascii(text))
    monkeypatch.setattr(hashing, "SEGMENT", 64)
    assert (word_hashes(lower_ascii(text)) == whole).all()
    several = list(batch_words(["alpha", None, text, "", "BETA gamma"], SPACED))
    assert [len(x) for x in several] == [1, 0, len(whole), 0, 2]
    assert (several[2] == whole).all() and several[4][0] == whole[1]


def test_a_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for size in (1, 5, 60, 3000):
        both = rng.integers(0, 2**63, 2 * size, dtype=np.uint64)
        a, b = minhash.sketch(np.unique(both[: size + size // 2])), minhash.sketch(np.unique(both[size // 2:]))
        assert abs((a == b).mean() - len(both[size // 2: size + size // 2]) / len(both)) < 0.2

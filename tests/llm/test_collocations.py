"""Phrase collocations against brute force, and the summaries' guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kindred.llm import collocations
from kindred.llm.collocations import Filter, merged

SCHEMA = "doc_id long, text string, lang string, phrase string, a long, n long, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, "x", 1, 2, "y") for i, (text, lang) in enumerate(rows)], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, threshold, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                f[lang].update(tuple(words[i: i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = [p for p, a in counts.items() if len(p) > 1 and a >= threshold]
        inside = defaultdict(int)
        for p in candidates:
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], counts[p])
        found = []
        for p in candidates:
            a = counts[p]
            if 100 * inside[p] >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def prose(rnd, count):
    words = ["of", "the", "York", "new", "a", "é", "ñandú", "x-y", "1", "A", "b c", "d\te"]
    return "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\r\n", "\t"]) for _ in range(count))


@pytest.mark.parametrize("threshold", [1, 3, 20])
def test_equals_brute_force(spark, threshold):
    rnd = random.Random(threshold)
    rows = [(prose(rnd, rnd.randrange(60)), rnd.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += [("new york city hall is new york city hall", "en")] * 30 + [(None, "en"), ("", "fr"), (" \t.\n", "fr")]
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, rows), threshold, top=40).collect())
    assert got == brute(rows, threshold, 40) and got


def test_longer_texts_are_cut_between_pieces(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(prose(rnd, 3000), "en"), ("one two three " * 4000, "en"), ("w" * 50_000 + " one two", "en")]
    monkeypatch.setattr(collocations, "GATHERED", 500)
    monkeypatch.setattr(collocations, "HELD", 30)
    chunks = collocations.chunks
    monkeypatch.setattr(collocations, "chunks", lambda *a, **k: chunks(*a, **{**k, "size": 700}))
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, rows), 20).collect())
    assert got == brute(rows, 20, 2000)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(prose(rnd, 50), "en") for _ in range(50)]
    monkeypatch.setattr(collocations, "FILTER_BITS", 8)
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, rows), 10).collect())
    assert got == brute(rows, 10, 2000)


def test_empty_tables(spark):
    for rows in ([], [(None, None)], [("one", "en")]):
        assert collocations.collocations(table(spark, rows), 1).collect() == []


def test_scores_beyond_64_bits_are_exact(spark):
    a, l, r, n = 10**11 + 7, 10**11 + 9, 3 * 10**11 + 1, 10**13 + 3
    rows = [("en", None, 0, n), ("en", "x", 1, l), ("en", "y", 1, r), ("en", "x y", 2, a)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, n_words int, a long")
    assert collocations.scored(counts).first().score == 1000 * a * n // (l * r)


def test_summaries_keep_every_frequent_key():
    rnd = np.random.default_rng(1)
    for _ in range(20):
        keys = rnd.zipf(1.3, 5000) % 4000
        summary = (np.empty(0, np.uint32), np.empty(0, np.int64))
        off = 0
        threshold = 50
        kept, counts, off = merged(keys.astype(np.uint32), np.ones(len(keys), np.int64), threshold)
        truth = Counter(keys.tolist())
        assert len(kept) <= len(keys) // threshold + 1 and off < threshold
        found = dict(zip(kept.tolist(), counts.tolist()))
        for key, times in truth.items():
            assert found.get(key, 0) <= times <= found.get(key, 0) + off
            if times >= threshold:
                assert key in found


def test_filter_bits():
    table = Filter(4, 64)
    flags = np.zeros(64, bool)
    flags[[3, 40]] = True
    table.fill(2, np.packbits(flags, bitorder="little").tobytes())
    key = lambda part, low: np.array([(part << 32) | low], np.uint64)
    assert table.has(key(2, 3)) and table.has(key(6, 40 + 64)) and not table.has(key(1, 3)) and not table.has(key(2, 4))

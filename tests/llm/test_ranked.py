"""Ranked search against brute force; blocks are skipped, and only where bounds allow."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kindred.llm import ranked
from kindred.llm.ranked import Best, Shard

DOCS, ITEMS = "doc_id long, text string, rank string, score string, n long", "item_id long, text string, doc_id long"


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    held = [(i, Counter(words(t))) for i, t in docs if i is not None]
    held = [(i, c) for i, c in held if c]
    count, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    terms = {}
    for item, text in items:
        if item is not None:
            terms.setdefault(item, set()).update(words(text))
    out = []
    for item, own in terms.items():
        scores = []
        for i, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * count) // length
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                scores.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, docs, items, k=10):
    rows = ranked.search(
        spark.createDataFrame([(i, t, "x", "y", 3) for i, t in docs], DOCS), spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS), k
    )
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in rows.collect())


def tables(seed, documents=300, items=25):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["É", "ñu", "The", "of"]
    text = lambda n: " ".join(vocabulary[min(len(vocabulary) - 1, int(rnd.paretovariate(0.7)) - 1)] + rnd.choice(["", ",", "-"]) for _ in range(n))
    docs = [(i, text(rnd.randrange(80))) for i in range(documents)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)] + [(5000, None), (5001, ""), (None, text(9)), (5002, "w1 " * 30_000), (5003, docs[7][1].upper())]
    asked = [(i, text(rnd.randrange(1, 30))) for i in range(items)] + [(900, None), (901, "zzz"), (None, "w1"), (3, "w99 w98"), (902, docs[3][1])]
    return docs, asked


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = tables(seed)
    assert found(spark, docs, items) == brute(docs, items)


def test_small_shards_groups_and_portions(spark, monkeypatch):
    docs, items = tables(4)
    for name, value in (("SHARD", 16), ("TOGETHER", 20), ("BLOCK", 2), ("PORTION", 100)):
        monkeypatch.setattr(ranked, name, value)
    assert found(spark, docs, items) == brute(docs, items)


def test_without_room_for_summaries_nothing_is_skipped_or_lost(spark, monkeypatch):
    docs, items = tables(5)
    monkeypatch.setattr(ranked, "SUMMARIES", 4)
    assert found(spark, docs, items) == brute(docs, items)


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "alpha beta") for i in range(50, 0, -1)] + [(i, "gamma") for i in range(100, 130)]
    got = found(spark, docs, [(1, "alpha"), (2, "gamma beta")], 3)
    assert [(q, r, i) for q, r, i, _ in got if q == 1] == [(1, 1, 1), (1, 2, 2), (1, 3, 3)] and got == brute(docs, [(1, "alpha"), (2, "gamma beta")], 3)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []


def test_blocks_are_skipped_by_exact_bounds():
    rnd = np.random.default_rng(1)
    impacts = np.where(rnd.random((600, 40)) < 0.2, rnd.integers(1, 1000, (600, 40)), 0).astype(np.int32)
    impacts[:100, :10] *= 5
    weights = rnd.integers(1, 50, 40)
    shard = Shard(np.arange(600), impacts, weights)
    for b in range(len(shard.start)):
        docs = shard.docs[shard.start[b]: shard.end[b]]
        assert (shard.summary[b] == shard.impacts[docs].max(axis=0)).all() and 1 <= len(docs)
    blocks = skipped = 0
    for _ in range(30):
        terms = np.sort(rnd.choice(40, 6, replace=False))
        best = Best(5)
        more, left = shard.answer(terms, best)
        blocks, skipped = blocks + more, skipped + left
        scores = impacts[:, terms].astype(np.int64) @ weights[terms]
        order = np.lexsort((np.arange(600), -scores))[:5]
        assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    assert 0.2 * blocks < skipped < blocks

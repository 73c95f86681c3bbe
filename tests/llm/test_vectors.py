"""Vector joins and search against brute force, with copies, scaled copies and unusable rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import ann, subspace

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def planted(seed, d=64, count=260):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    while len(rows) < count:
        base = rng.normal(size=d)
        for _ in range(int(rng.choice([1, 1, 2, 12]))):
            noise = rng.normal(size=d) * rng.choice([0, 0.08, 0.14, 0.2])
            rows.append((i, (rng.choice([1.0, 3.0]) * (base + noise)).astype(np.float32).tolist(), int(rng.integers(0, 2)) if rng.random() < 0.1 else 1, "x"))
            i += 1
    return rows


def odd(d=64):
    one = [1.0] * d
    return [
        (1000, None, 1, "x"), (1001, [0.0] * d, 1, "x"), (1002, [float("nan")] * d, 1, "x"), (1003, [float("inf")] + one[1:], 1, "x"),
        (1004, [None] + one[1:], 1, "x"), (1005, [], 1, "x"), (1006, one, None, "x"), (1007, one, 1, "x"), (1008, one, 1, "x"),
        (1008, one, 1, "x"), (1009, one[:9], 1, "x"), (1010, [2.0] * 9, 1, "x"), (1011, [-1.0] * d, 1, "x"), (None, one, 1, "x"),
        (1012, [-0.0] * d, 1, "x"), (1013, [1e-30] * d, 1, "x"),
    ]


def fine(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, dtype=float), np.array(b, dtype=float)
    return (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))


def brute_links(rows):
    able = [i for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and fine(r[1])]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(able):
        for j in able[:x]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= 0.98:
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(i)] = find(j)
            elif rows[i][0] == rows[j][0]:
                root[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(i)] = min(smallest.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], smallest[find(i)] if r[0] is not None else None) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("tile", [1500, 7])
def test_links_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(subspace, "TILE", tile)
    rows = planted(1) + odd()
    out = subspace.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str) == brute_links(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)


@pytest.mark.parametrize("d", [3, 8, 20])
def test_other_dimensions(spark, d):
    rows = planted(2, d, 90)
    out = subspace.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str) == brute_links(rows)


def test_every_close_pair_meets_once():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 64))
    rows = np.concatenate([base, base + 0.1 * rng.normal(size=base.shape)])
    seen = {}
    for number, index, cells, home in subspace.memberships(rows, 0.98):
        for i, c, h in zip(index, cells, home):
            seen.setdefault((number, c), []).append((i, h))
    found = []
    for (number, _), members in seen.items():
        index = np.array([i for i, _ in members])
        home = np.array([h for _, h in members])
        for i, j in subspace.tile_links(rows[index], home, np.zeros(len(index), int), (0, 0), number, 0.98):
            found += [tuple(sorted(p)) for p in zip(index[i].tolist(), index[j].tolist())]
    expected = sorted((i, j) for i in range(80) for j in range(i + 1, 80) if cosine(rows[i], rows[j]) >= 0.98)
    assert sorted(found) == expected and len(expected) >= 20


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert subspace.near_vectors(empty).count() == 0
    assert ann.search(empty, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("block", [8192, 100])
def test_search_recall_scores_and_order(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rows = planted(4, count=900) + odd()
    out = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 9 == 0).collect()
    vectors = {r[0]: r[1] for r in rows if r[0] is not None and fine(r[1])}
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert r.score == pytest.approx(cosine(vectors[r.query_id], vectors[r.vec_id]), abs=1e-12)
    hits = wanted = 0
    assert set(found) == {i for i in vectors if i % 9 == 0 and sum(len(v) == len(vectors[i]) for v in vectors.values()) > 1}
    for q, got in found.items():
        got.sort()
        assert [x[0] for x in got] == list(range(1, len(got) + 1))
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        best = sorted((-cosine(vectors[q], v), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))[:5]
        hits += len({i for _, i in best} & {i for _, i, _ in got})
        wanted += len(best)
        assert len(got) == len(best)
    assert hits >= 0.95 * wanted


def test_copies_tie_to_the_smaller_id(spark):
    rng = np.random.default_rng(0)
    copy = rng.normal(size=16).tolist()
    rows = [(i, copy, 1, "x") for i in range(40)] + [(i, rng.normal(size=16).tolist(), 1, "x") for i in range(40, 80)]
    out = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 30).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [0, 1, 2, 3, 4] and len({r.score for r in out}) == 1


@pytest.mark.parametrize("block, count", [(8192, 15), (12, 60)])
@pytest.mark.parametrize("close", [1, 6, 40])
def test_repeated_rows_count_once(spark, monkeypatch, block, count, close):
    """Blocks of at most 16 ids are searched whole."""
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(size=16) for i in range(count)}
    vectors[7] = vectors[3] + 0.01 * rng.normal(size=16)
    rows = [(i, v.tolist(), 1, "x") for i, v in vectors.items() for _ in range(2)] + [(7, vectors[7].tolist(), 1, "x")] * (close - 1)
    out = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 3).orderBy("rank").collect()
    best = sorted((-cosine(vectors[3], v), i) for i, v in vectors.items() if i != 3)[:5]
    assert [r.vec_id for r in out] == [i for _, i in best]

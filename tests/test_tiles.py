"""The tile kernel by itself."""

import numpy as np
import pandas as pd
import pytest

from kindred.operators import tiles


def block(seed, users=25, items=40, n=9):
    rng = np.random.default_rng(seed)
    rows = [
        (u + 100 * seed, i, rng.normal(), rng.normal(), n)
        for u in range(users) for i in sorted({0, *rng.choice(items, n, replace=False)})
    ]
    return pd.DataFrame(rows, columns=["user_id", "item_id", "weight", "dev", "n_rated"])


def dense(frame, value):
    table = np.zeros((25, 40))
    table[frame["user_id"] % 100, frame["item_id"]] = frame[value] if value else 1
    return table


@pytest.mark.parametrize("block_pairs", [1, 50, 10**9])
@pytest.mark.parametrize("batch_pairs", [1, 37, 10**6])
def test_large_and_small_items_add_up(monkeypatch, block_pairs, batch_pairs):
    monkeypatch.setattr(tiles, "BLOCK_PAIRS", block_pairs)
    monkeypatch.setattr(tiles, "BATCH_PAIRS", batch_pairs)
    left, right = block(1), block(2)
    table, mask = tiles.similarity_table(tiles.Block(left), tiles.Block(right), "cosine")
    assert np.allclose(table, dense(left, "weight") @ dense(right, "weight").T, atol=1e-9)
    shared, _ = tiles.similarity_table(tiles.Block(left), tiles.Block(right), "overlap")
    assert (shared == dense(left, None) @ dense(right, None).T).all() and (mask == (shared > 0)).all()


@pytest.mark.parametrize("k", [1, 3, 24, 25, 99])
def test_best_of_rows_breaks_ties_by_id(k):
    rng = np.random.default_rng(3)
    table = rng.integers(0, 4, (6, 25)) / 4
    mask = rng.random((6, 25)) < 0.7
    users, others = np.arange(6), np.arange(25) * 2
    best = tiles.best_of_rows(users, others, table, mask, k)
    for u in users:
        expected = sorted((-table[u, c], others[c]) for c in range(25) if mask[u, c])[:k]
        mine = best[best["user_id"] == u]
        assert [(-s, v) for v, s in zip(mine["neighbor_id"], mine["similarity"])] == expected


def test_light_sums_are_added_in_both_halves(tmp_path):
    left, right = block(1), block(2)
    light = pd.DataFrame(
        [(100, 203, 0, 0, 0.25, 2), (101, 200, 0, 0, -0.5, 1), (999, 200, 0, 0, 9.0, 1)],
        columns=["first", "second", "kind", "item_id", "value", "shared"],
    )
    table, _ = tiles.similarity_table(tiles.Block(left), tiles.Block(right), "cosine", light)
    expected = dense(left, "weight") @ dense(right, "weight").T
    expected[0, 3] += 0.25
    expected[1, 0] -= 0.5
    assert np.allclose(table, expected, atol=1e-9)
    one = tiles.Block(left)
    light["second"] = [103, 100, 100]
    shared, _ = tiles.similarity_table(one, one, "overlap", light)
    plain = dense(left, None) @ dense(left, None).T
    assert shared[0, 3] == plain[0, 3] + 2 == shared[3, 0] and shared[1, 0] == plain[1, 0] + 1 == shared[0, 1]

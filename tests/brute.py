"""Plain-Python collaborative filtering for small fixtures: the formulas, nothing else."""

from __future__ import annotations

import math
from collections import defaultdict


def scale(x, a, lo=1.0, hi=5.0):
    return hi - a if x > a else a - lo if x < a else 1.0


def dev(r, a):
    return 0.0 if abs(r - a) < 1e-9 else (r - a) / scale(r, a)


def denorm(a, d):
    return a + d * scale(a + d, a)


def half_up(x, places=9):
    return math.floor(x * 10.0**places + 0.5) / 10.0**places


class Brute:
    """Everything about one list of (user, item, rating)."""

    def __init__(self, rows):
        self.by_user = defaultdict(dict)
        for u, i, r in rows:
            self.by_user[u][i] = r
        self.mean = {u: sum(x.values()) / len(x) for u, x in self.by_user.items()}
        self.dev = {u: {i: dev(r, self.mean[u]) for i, r in x.items()} for u, x in self.by_user.items()}
        self.norm = {u: math.sqrt(sum(d * d for d in x.values())) for u, x in self.dev.items()}

    def pairs(self, metric):
        out = {}
        users = sorted(self.by_user)
        for n, u in enumerate(users):
            for v in users[n + 1:]:
                shared = self.by_user[u].keys() & self.by_user[v].keys()
                if not shared:
                    continue
                if metric == "overlap":
                    out[u, v] = float(len(shared))
                elif metric == "jaccard":
                    out[u, v] = half_up(len(shared) / len(self.by_user[u].keys() | self.by_user[v].keys()))
                elif self.norm[u] > 0 and self.norm[v] > 0:
                    out[u, v] = half_up(sum(
                        self.dev[u][i] / self.norm[u] * (self.dev[v][i] / self.norm[v]) for i in shared
                    ))
        return out

    def ranked(self, metric="cosine"):
        lists = defaultdict(list)
        for (u, v), s in self.pairs(metric).items():
            lists[u].append((-s, v))
            lists[v].append((-s, u))
        return {u: [(v, -s) for s, v in sorted(x)] for u, x in lists.items()}

    def wdev(self, neighbors, i):
        num = den = 0.0
        for v, s in neighbors:
            if i in self.dev[v]:
                num += s * self.dev[v][i]
                den += abs(s)
        return num / den if den else None

    def predict(self, wanted, ranked, k=None, fallback=True):
        out = {}
        for u, i, *_ in wanted:
            if u in self.mean:
                d = self.wdev(ranked.get(u, [])[:k], i)
                a = self.mean[u]
                out[u, i] = denorm(a, d) if d is not None else (a if fallback else None)
        return out

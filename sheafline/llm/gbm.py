"""A small gradient-boosted classifier in numpy: logistic loss, histogram trees of fixed depth."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees as arrays, so that a model travels to the workers as a few kilobytes."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: float = 5.0):
        self.trees, self.depth, self.rate, self.bins, self.l2, self.least = trees, depth, rate, bins, l2, least
        self.base = 0.0
        self.splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, m = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        code = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1) if m else np.zeros((n, 0), int)
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(p / (1 - p)))
        f = np.full(n, self.base)
        nodes = 2**self.depth - 1
        for _ in range(self.trees):
            q = 1 / (1 + np.exp(-f))
            g, h = y - q, q * (1 - q)
            feat, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(2 ** (self.depth + 1) - 1)
            where = np.zeros(n, dtype=np.int64)
            for node in range(nodes):
                at = np.flatnonzero(where == node)
                if not len(at):
                    continue
                best = (1e-6, -1, 0)
                gs, hs = g[at].sum(), h[at].sum()
                for j in range(m):
                    size = len(edges[j]) + 1
                    if size < 2:
                        continue
                    gb = np.cumsum(np.bincount(code[at, j], g[at], size))[:-1]
                    hb = np.cumsum(np.bincount(code[at, j], h[at], size))[:-1]
                    gain = gb**2 / (hb + self.l2) + (gs - gb) ** 2 / (hs - hb + self.l2) - gs**2 / (hs + self.l2)
                    gain[(hb < self.least / 20) | (hs - hb < self.least / 20)] = -1
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
                if best[1] >= 0:
                    feat[node], cut[node] = best[1], edges[best[1]][best[2]]
                    where[at] = 2 * node + 1 + (code[at, best[1]] > best[2])
            for leaf in np.unique(where):
                at = where == leaf
                value[leaf] = self.rate * g[at].sum() / (h[at].sum() + self.l2)
            f += value[where]
            self.splits.append((feat, cut, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feat, cut, value in self.splits:
            where = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                inner = where < len(feat)
                node = np.where(inner, where, 0)
                go = inner & (feat[node] >= 0)
                right = x[rows, np.maximum(feat[node], 0)] > cut[node]
                where = np.where(go, 2 * where + 1 + right, where)
            f += value[where]
        return 1 / (1 + np.exp(-f))

"""Gradient-boosted trees for two classes: a short numpy fit on a bounded sample, and scoring as arrays or as SQL.

Trees have a fixed depth; features are cut at quantiles; each tree fits the gradient of the logistic
loss with second-order leaf values. Fitting is deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes; a row goes right where its value is larger
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row."""
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return total

    def sql(self, names: list[str]) -> str:
        """The log-odds as an SQL expression over columns ``names``."""
        inner = self.feature.shape[1]

        def walk(t: int, node: int) -> str:
            if node >= inner:
                return f"{float(self.leaf[t, node - inner])!r}D"
            low, high = walk(t, 2 * node + 1), walk(t, 2 * node + 2)
            cut = float(self.cut[t, node])
            if low == high or not np.isfinite(cut):
                return low
            return f"CASE WHEN {names[self.feature[t, node]]} > {cut!r}D THEN {high} ELSE {low} END"

        return " + ".join([f"{float(self.base)!r}D", *[walk(t, 0) for t in range(len(self.feature))]])


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, l2: float = 1.0) -> Trees:
    """Trees for rows ``x`` and labels ``y`` (0 or 1); without both classes only the base is set."""
    n, inner = len(y), 2**depth - 1
    share = (float(np.sum(y)) + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    width = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]
    total, out = np.full(n, base), ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            best = np.full(count, 1e-9)
            split = np.full(count, -1)
            for f in range(width):
                b = len(cuts[f]) + 1
                if b < 2:
                    continue
                cell = at * b + binned[f]
                gs = np.bincount(cell, g, count * b).reshape(count, b).cumsum(1)
                hs = np.bincount(cell, h, count * b).reshape(count, b).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + l2) + (ga - gs) ** 2 / (ha - hs + l2) - ga**2 / (ha + l2)
                gain = gain[:, :-1]
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                better = top > best
                best[better], split[better] = top[better], k[better]
                feature[first : first + count][better] = f
            for j in np.flatnonzero(split >= 0):
                cut[first + j] = cuts[feature[first + j]][split[j]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        leaf = np.bincount(node - inner, g, inner + 1) / (np.bincount(node - inner, h, inner + 1) + l2) * rate
        total += leaf[node - inner]
        for store, value in zip(out, (feature, cut, leaf)):
            store.append(value)
    return Trees(base, *map(np.array, out))

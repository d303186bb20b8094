"""Histogram gradient-boosted trees for a yes or no label, kept as flat arrays.

Values are sorted into at most `bins` bins per feature; a tree grows level by level, each level choosing its splits from
sums of gradients per (node, feature, bin). A tree of depth d is a row of 2 ** d - 1 tests and 2 ** d
leaves, so a whole forest is walked with d vectorised steps for all rows and trees together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    base: float
    feature: np.ndarray  # (trees, tests)
    limit: np.ndarray  # (trees, tests): to the right if the value is above
    leaf: np.ndarray  # (trees, leaves)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The chance of label 1 for each row of feature values."""
        trees, tests = self.feature.shape
        if not trees or not len(rows):
            return np.full(len(rows), _chance(self.base))
        at = np.zeros((len(rows), trees), np.int64)
        every, who = np.arange(trees)[None, :], np.arange(len(rows))[:, None]
        for _ in range((tests + 1).bit_length() - 1):
            at = 2 * at + 1 + (rows[who, self.feature[every, at]] > self.limit[every, at])
        return _chance(self.base + self.leaf[every, at - tests].sum(axis=1))


def _chance(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, least: float = 3.0, ridge: float = 1.0) -> Forest:
    """Fit to labels 0 and 1. Without rows, or with one label only, every score is that of the (smoothed) share of 1."""
    rows, labels = rows.astype(np.float64), labels.astype(np.float64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    base, tests = float(np.log(share / (1 - share))), 2**depth - 1
    if not len(labels) or labels.min() == labels.max():
        return Forest(base, np.zeros((0, tests), np.int64), np.zeros((0, tests)), np.zeros((0, tests + 1)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in rows.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T)], axis=1)
    n, width = binned.shape
    total, out = np.full(n, base), Forest(base, np.zeros((trees, tests), np.int64), np.zeros((trees, tests)), np.zeros((trees, tests + 1)))
    cell = np.arange(width)[None, :] * bins + binned
    for t in range(trees):
        p = _chance(total)
        g, h, at = labels - p, p * (1 - p), np.zeros(n, np.int64)
        for d in range(depth):
            first, nodes = 2**d - 1, 2**d
            flat = ((at - first)[:, None] * width * bins + cell).ravel()
            of = lambda v: np.bincount(flat, np.repeat(v, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(axis=2)
            gl, hl = of(g), of(h)
            gr, hr = gl[:, :, -1:] - gl, hl[:, :, -1:] - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge)
            gain[(hl < least) | (hr < least)] = -1
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = -1
            best = gain.reshape(nodes, -1).argmax(axis=1)
            whole = gl[:, 0, -1] ** 2 / (hl[:, 0, -1] + ridge)
            found = gain.reshape(nodes, -1)[np.arange(nodes), best] > whole + 1e-9
            feature, cut = best // bins, best % bins
            limit = np.array([edges[f][min(c, len(edges[f]) - 1)] if ok else np.inf for f, c, ok in zip(feature, cut, found)])
            out.feature[t, first : first + nodes] = np.where(found, feature, 0)
            out.limit[t, first : first + nodes] = limit
            own = at - first
            at = 2 * at + 1 + (rows[np.arange(n), np.where(found, feature, 0)[own]] > limit[own])
        leaf = at - tests
        value = rate * np.bincount(leaf, g, tests + 1) / (np.bincount(leaf, h, tests + 1) + ridge)
        out.leaf[t] = value
        total += value[leaf]
    return out

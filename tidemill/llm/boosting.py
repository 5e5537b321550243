"""Gradient-boosted trees in numpy for a softmax over a few classes.

A tree asks the same question in all nodes of a level, so a row's leaf is a number made of its answers.
"""

from __future__ import annotations

import numpy as np

BINS = 16
PART = 0.35  # of the rows, drawn anew for each round


class Boosted:
    """``trees``: (class, features, thresholds, values of the leaves)."""

    def __init__(self, start: np.ndarray, trees: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]):
        self.start, self.trees = start, trees

    def logits(self, rows: np.ndarray) -> np.ndarray:
        columns = np.ascontiguousarray(rows.T)
        out = np.tile(self.start, (len(rows), 1))
        for k, features, thresholds, values in self.trees:
            leaf = np.zeros(len(rows), dtype=np.uint8)
            for f, t in zip(features, thresholds):
                leaf = (leaf << 1) | (columns[f] > t)
            out[:, k] += values[leaf]
        return out

    def log_shares(self, rows: np.ndarray) -> np.ndarray:
        """Logarithms of the classes' probabilities."""
        x = self.logits(rows)
        x -= x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def fit(rows: np.ndarray, labels: np.ndarray, classes: int, rounds: int = 40, depth: int = 4, rate: float = 0.3,
        shrink: float = 2.0, seed: int = 5) -> Boosted:
    """Stochastic Newton boosting on histograms; a level takes the split that gains most over all its nodes."""
    n, width = rows.shape
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    cuts = [c[c < rows[:, f].max()] for f, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], axis=1)
    flat = binned + np.arange(width) * BINS
    usable = np.arange(BINS)[None, :] < np.array([len(c) for c in cuts])[:, None]
    share = np.maximum(np.bincount(labels, minlength=classes) / n, 1e-6)
    logits = np.tile(np.log(share), (n, 1))
    model = Boosted(np.log(share), [])
    target = np.eye(classes)[labels]
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        soft = np.exp(logits - logits.max(axis=1, keepdims=True))
        soft /= soft.sum(axis=1, keepdims=True)
        part = np.flatnonzero(rng.random(n) < PART) if n > 1000 else np.arange(n)
        some = flat[part]
        for k in range(classes):
            grad, hess = target[:, k] - soft[:, k], np.maximum(soft[:, k] * (1 - soft[:, k]), 1e-6)
            each_g, each_h = np.repeat(grad[part], width), np.repeat(hess[part], width)
            leaf, features, thresholds = np.zeros(n, dtype=np.int64), [], []
            for level in range(depth):
                nodes = 1 << level
                where = (leaf[part, None] * (width * BINS) + some).ravel()
                size = nodes * width * BINS
                g = np.bincount(where, each_g, size).reshape(nodes, width, BINS).cumsum(axis=2)
                h = np.bincount(where, each_h, size).reshape(nodes, width, BINS).cumsum(axis=2)
                whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
                gain = (g ** 2 / (h + shrink) + (whole_g - g) ** 2 / (whole_h - h + shrink)).sum(axis=0)
                best = np.argmax(np.where(usable, gain, -np.inf))
                f, b = divmod(int(best), BINS)
                features.append(f)
                thresholds.append(cuts[f][b])
                leaf = (leaf << 1) | (binned[:, f] > b)
            g, h = np.bincount(leaf, grad, 1 << depth), np.bincount(leaf, hess, 1 << depth)
            values = rate * g / (h + shrink)
            logits[:, k] += values[leaf]
            model.trees.append((k, np.array(features), np.array(thresholds), values))
    return model

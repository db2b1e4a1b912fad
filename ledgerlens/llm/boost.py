"""Gradient-boosted regression trees for two classes, on histograms of binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Boosting:
    trees: int = 40
    depth: int = 4
    rate: float = 0.3
    l2: float = 1.0
    min_rows: int = 5
    share: float = 0.5  # of the rows that a tree sees
    seed: int = 0


class Forest:
    """Complete binary trees of one depth, stored level by level.

    ``feature[t, i]`` and ``bound[t, i]`` say how inner node i of tree t parts: rows whose
    feature exceeds the bound go right. ``leaf[t]`` are the scores added."""

    def __init__(self, bias: float, feature: np.ndarray, bound: np.ndarray, leaf: np.ndarray):
        self.bias, self.feature, self.bound, self.leaf = bias, feature, bound, leaf

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of every row (rows by features)."""
        out = np.full(len(rows), self.bias)
        every = np.arange(len(rows))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (rows[every, feature[at]] > bound[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def fit(rows: np.ndarray, labels: np.ndarray, p: Boosting = Boosting()) -> Forest:
    """Newton steps on the logistic loss; splits by the best gain over binned features."""
    n, features = rows.shape if rows.ndim == 2 else (0, 0)
    inner, leaves = 2**p.depth - 1, 2**p.depth
    empty = Forest(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    share = float(labels.mean()) if n else 0.5
    if not n or not 0.0 < share < 1.0:
        # One class, or nothing, to learn from.
        empty.bias = 0.0 if not n else (40.0 if share else -40.0)
        return empty
    table = _Binned(rows)
    bias = float(np.log(share / (1 - share)))
    raw = np.full(n, bias)
    rng = np.random.default_rng(p.seed)
    out = []
    for _ in range(p.trees):
        chance = 1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40)))
        gradient, curve = labels - chance, np.maximum(chance * (1 - chance), 1e-6)
        seen = rng.random(n) < p.share
        weights = gradient * seen, curve * seen, seen.astype(float)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(p.depth):
            first, width = 2**level - 1, 2**level
            choice, cut = table.splits(at - first, width, weights, p)
            for k in np.flatnonzero(choice >= 0):
                feature[first + k] = choice[k]
                bound[first + k] = table.bounds[choice[k]][cut[k]]
            at = 2 * at + 1 + (rows[np.arange(n), feature[at]] > bound[at])
        own = at - inner
        g, h = np.bincount(own, weights[0], leaves), np.bincount(own, weights[1], leaves)
        leaf = p.rate * g / (h + p.l2)
        raw += leaf[own]
        out.append((feature, bound, leaf))
    return Forest(bias, *(np.array(part) for part in zip(*out, strict=True)))


class _Binned:
    """Values as numbers of bins; features of two values, flags, stand together."""

    def __init__(self, rows: np.ndarray):
        self.bounds, self.bins, flags = [], {}, {}
        for j, values in enumerate(rows.T):
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
            cuts = cuts[cuts < values.max()]
            if not len(cuts) and values.min() < values.max():
                cuts = values.min()[None]  # a rare flag
            self.bounds.append(cuts)
            if len(cuts):
                bins = np.searchsorted(cuts, values, side="left")
                if len(cuts) == 1:
                    flags[j] = bins.astype(np.float32)
                else:
                    self.bins[j] = bins
        self.flag_names = np.array(list(flags), np.int64)
        self.flags = np.array(list(flags.values()), np.float32)

    def splits(self, node: np.ndarray, width: int, weights, p: Boosting):
        """The best feature and cut of every node of a level; -1 where none gains."""
        best, choice, cut = np.full(width, 1e-6), np.full(width, -1), np.zeros(width, np.int64)
        total = np.stack([np.bincount(node, w, width) for w in weights])
        whole = total[0] ** 2 / (total[1] + p.l2)

        def offer(gain, features, cuts):
            top = gain.argmax(axis=0)
            own = gain[top, np.arange(width)]
            better = own > best
            best[better], choice[better], cut[better] = own[better], features[top[better]], cuts[top[better]]

        if len(self.flags):
            # Sums over the rows that have a flag, for all flags at once.
            parted = np.zeros((len(node), 3 * width), np.float32)
            for k, values in enumerate(weights):
                parted[np.arange(len(node)), k * width + node] = values
            right = (self.flags @ parted).astype(float).reshape(-1, 3, width)
            offer(_gain(total - right, total, whole, p), self.flag_names, np.zeros(len(self.flags), np.int64))
        for j, bins in self.bins.items():
            key = node * BINS + bins
            sums = [np.bincount(key, w, width * BINS).reshape(width, BINS).cumsum(axis=1) for w in weights]
            offer(_gain(np.stack(sums).transpose(2, 0, 1), total, whole, p), np.full(BINS, j), np.arange(BINS))
        return choice, cut


def _gain(left: np.ndarray, total: np.ndarray, whole: np.ndarray, p: Boosting) -> np.ndarray:
    """Gain of cutting off ``left`` (cuts by gradient, curvature, rows by nodes)."""
    right = total - left
    gain = left[:, 0] ** 2 / (left[:, 1] + p.l2) + right[:, 0] ** 2 / (right[:, 1] + p.l2) - whole
    return np.where((left[:, 2] < p.min_rows) | (right[:, 2] < p.min_rows), -1.0, gain)

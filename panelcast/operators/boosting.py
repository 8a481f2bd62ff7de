"""Boosted trees of few rows within one task: the trees of Spark ML's ``GBTRegressor``, without a job per level.

Spark ML starts several jobs per level of each tree, however few rows there are, so a search of hundreds of fits
over a small pooled panel waits for its jobs. Here a fit is one task and a search one job. The rules are Spark ML's:
at most 32 bins per feature from its quantiles, least squared error over all bins (the first of equal splits), a
level at a time, the first tree whole, the later ones on the doubled residuals and shrunk, rows drawn per tree by
its generator per partition. Up to ``MOST_ROWS`` rows Spark ML takes its bins from all rows; larger fits are its own.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np

MOST_ROWS = 10_000  # fixed value: Spark ML samples the rows for its bins beyond it
MOST_BINS = 32  # fixed value: Spark ML's default
EPSILON = 2.0 ** -52  # fixed value: a node of less variance is a leaf
_ARRAY_SEED = 0x3C074A61  # fixed value: Scala's seed for hashes of arrays


def _murmur3(words: list[int], seed: int) -> int:
    """MurmurHash3 (32 bits) of little-endian words."""
    def turned(v: int, r: int) -> int:
        return (v << r | v >> 32 - r) & 0xFFFFFFFF

    h = seed
    for w in words:
        h ^= turned(w * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = turned(h, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= 4 * len(words)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _state(seed: int) -> int:
    """The generator's state for a seed."""
    raw = (seed & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big")
    words = [int.from_bytes(raw[i:i + 4], "little") for i in (0, 4)]
    low = _murmur3(words, _ARRAY_SEED)
    return _murmur3(words, low) << 32 | low


def drawn(n_rows: int, n_trees: int, rate: float, seed: int) -> np.ndarray:
    """``(tree, row)``: whether the tree sees the row; all trees' generators step together."""
    if rate == 1.0:
        return np.ones((n_trees, n_rows), bool)
    s = np.array([_state(seed + m + 1) for m in range(n_trees)], np.uint64)
    shifts = [np.uint64(v) for v in (21, 35, 4)]

    def bits(n: int) -> np.ndarray:
        nonlocal s
        s = s ^ s << shifts[0]
        s = s ^ s >> shifts[1]
        s = s ^ s << shifts[2]
        return s & np.uint64(2 ** n - 1)

    out = np.empty((n_trees, n_rows), bool)
    for r in range(n_rows):
        high = bits(26) << np.uint64(27)
        out[:, r] = (high + bits(27)).astype(np.float64) * 2.0 ** -53 < rate
    return out


def thresholds(values: np.ndarray) -> np.ndarray:
    """Split points of one feature: between all its values while they are few, else at steps of equal counts."""
    distinct, counts = np.unique(values + 0.0, return_counts=True)
    most = min(MOST_BINS, len(values)) - 1
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= most:
        return middles
    found, stride = [], len(values) / (most + 1)
    target, sums = stride, np.cumsum(counts).tolist()
    for i in range(1, len(sums)):
        if abs(sums[i - 1] - target) < abs(sums[i] - target):
            found.append(i - 1)
            target += stride
    return middles[found]


def _variance(n, s, q):
    """Mean squared deviation from count, sum and sum of squares (0 without rows)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (q - s * s / n) / n, 0.0)


def _tree(binned: np.ndarray, codes: np.ndarray, n_splits: np.ndarray, seen: np.ndarray, label: np.ndarray, depth: int, leaf: int) -> np.ndarray:
    """One tree on the rows ``seen`` of the first ``len(label)`` rows; its prediction for every row."""
    n_features, every = len(n_splits), np.arange(len(binned))
    splits = np.arange(MOST_BINS - 1)
    usable = splits < n_splits[:, None]
    out, rows = np.empty(len(binned)), np.flatnonzero(seen)
    y = label[rows]
    node, mine = np.zeros(len(binned), np.int64), np.zeros(len(rows), np.int64)  # the open node of a row; -1 in a leaf
    stats = np.array([[len(rows), y.sum(), (y * y).sum()]])
    impurity = _variance(*stats.T)
    for level in range(depth + 1):
        value = stats[:, 1] / np.maximum(stats[:, 0], 1)
        closed = np.full(len(stats), level == depth) if level else np.array([depth == 0])
        if level:
            closed |= np.abs(impurity) < EPSILON
        split = np.zeros(len(stats), bool)
        if not closed.all():
            q, size = len(stats), n_features * MOST_BINS
            at = (mine[:, None] * size + codes[rows]).ravel()
            shape = (q, n_features, MOST_BINS)
            sums = [np.bincount(at, w, q * size).reshape(shape).cumsum(2)
                    for w in (None, np.repeat(y, n_features), np.repeat(y * y, n_features))]
            left = [x[:, :, :-1] for x in sums]
            right = [x[:, :, -1:] - x[:, :, :-1] for x in sums]
            n, total = left[0], sums[0][:, :, -1:]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = impurity[:, None, None] - n / total * _variance(*left) - right[0] / total * _variance(*right)
            gain[~((n >= leaf) & (right[0] >= leaf) & usable & (gain >= 0))] = -1.0
            gain = gain.reshape(q, -1)
            best = gain.argmax(1)
            split = ~closed & (gain[np.arange(q), best] > 0)
        done = ~split
        here = node >= 0
        last = here & done[node]
        out[last] = value[node[last]]
        if not split.any():
            return out
        f, cut = np.divmod(best, MOST_BINS - 1)
        first = 2 * (np.cumsum(split) - 1)  # children of the nodes that are split, left then right
        old = node[here]
        node[here] = np.where(split[old], first[old] + (binned[every[here], f[old]] > cut[old]), -1)
        kept = split[mine]
        rows, y = rows[kept], y[kept]
        mine = node[rows]
        pick = np.flatnonzero(split)
        stats = np.stack([np.stack([x[pick, f[pick], cut[pick]] for x in side], 1) for side in (left, right)], 1).reshape(-1, 3)
        impurity = _variance(*stats.T)
    return out


def boosted(x: np.ndarray, label: np.ndarray, scored: np.ndarray, params: Mapping, seed: int, part: np.ndarray | None = None) -> np.ndarray:
    """Predictions for the rows ``scored`` by the trees of the rows ``x`` with their labels; ``part`` is each row's partition, ascending."""
    cuts = [thresholds(c) for c in x.T]
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, np.concatenate([x, scored]).T)], 1)
    codes = binned[:len(x)] + np.arange(x.shape[1]) * MOST_BINS
    n_splits = np.array([len(c) for c in cuts])
    trees, rate = int(params["n_estimators"]), float(params["learning_rate"])
    parts = zip(*np.unique(np.zeros(len(x), int) if part is None else part, return_counts=True))
    seen = np.hstack([drawn(int(n), trees, float(params["subsample"]), seed + int(p)) for p, n in parts])
    out = np.zeros(len(binned))
    for m in range(trees):
        residual = 2.0 * (label - out[:len(x)]) if m else label
        out += (rate if m else 1.0) * _tree(binned, codes, n_splits, seen[m], residual, int(params["max_depth"]),
                                            int(params.get("min_samples_leaf", 1)))
    return out[len(x):]

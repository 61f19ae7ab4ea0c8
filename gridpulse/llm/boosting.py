"""Gradient-boosted trees on histograms, with monotonic constraints.

Training sees a bounded sample. The result is flat: node arrays of all trees
end to end, so that scoring is a few array gathers for each tree level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """``feature`` -1 marks a leaf. ``depth`` gathers bring each row to its leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                feature = self.feature[node]
                goes_left = x[rows, np.maximum(feature, 0)] <= self.threshold[node]
                below = np.where(goes_left, self.left[node], self.right[node])
                node = np.where(feature < 0, node, below)
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    l2: float = 1.0,
    min_hessian: float = 2.0,
) -> Trees:
    """Boost the logistic loss.

    ``monotone`` holds +1, -1 or 0 for each feature. A constrained split must
    order its children's values, and each side's later values are clipped at
    the middle of the two, so that the whole model is monotonic.
    """
    n, width = x.shape
    share = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    codes = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], 1) if n else np.zeros((0, width), int)
    out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    margin, roots = np.full(n, bias), []

    def add(feature=-1, threshold=0.0, value=0.0) -> int:
        for k, v in (("feature", feature), ("threshold", threshold), ("left", 0), ("right", 0), ("value", value)):
            out[k].append(v)
        return len(out["feature"]) - 1

    def leaf_value(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + l2), low, high))

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, -1, 0)
        if level < depth and h >= 2 * min_hessian:
            for f in range(width):
                if not len(edges[f]):
                    continue
                size = len(edges[f]) + 1
                gl = np.cumsum(np.bincount(codes[rows, f], grad[rows], size))[:-1]
                hl = np.cumsum(np.bincount(codes[rows, f], hess[rows], size))[:-1]
                gr, hr = g - gl, h - hl
                vl, vr = (np.clip(-a / (b + l2), low, high) for a, b in ((gl, hl), (gr, hr)))

                def gain(a, b, v):
                    return -(a * v + 0.5 * (b + l2) * v * v)

                v0 = leaf_value(g, h, low, high)
                won = gain(gl, hl, vl) + gain(gr, hr, vr) - gain(g, h, v0)
                won[(hl < min_hessian) | (hr < min_hessian)] = -np.inf
                if monotone[f]:
                    won[(vr - vl) * monotone[f] < 0] = -np.inf
                k = int(np.argmax(won))
                if won[k] > best[0]:
                    best = (float(won[k]), f, k)
        if best[1] < 0:
            value = leaf_value(g, h, low, high) * rate
            margin[rows] += value
            return add(value=value)
        _, f, k = best
        node = add(f, float(edges[f][k]))
        goes_left = codes[rows, f] <= k
        a, b = rows[goes_left], rows[~goes_left]
        bounds = [(low, high), (low, high)]
        if monotone[f]:
            mid = (leaf_value(grad[a].sum(), hess[a].sum(), low, high) + leaf_value(grad[b].sum(), hess[b].sum(), low, high)) / 2
            bounds = [(low, mid), (mid, high)] if monotone[f] > 0 else [(mid, high), (low, mid)]
        out["left"][node] = grow(a, level + 1, *bounds[0])
        out["right"][node] = grow(b, level + 1, *bounds[1])
        return node

    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
    arrays = {k: np.array(v, np.float64 if k in ("threshold", "value") else np.int64) for k, v in out.items()}
    return Trees(**arrays, roots=np.array(roots, np.int64), depth=depth, bias=bias)

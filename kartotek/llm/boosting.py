"""Gradient boosted trees and Platt calibration: from a bounded table, or grown level by level from sums.

``grow`` sees rows only through sums by node, feature and bin (``cells``), which tasks add up apart. Gradients
are summed as integers and leaves are multiples of 1/LEAF, so neither order nor layout changes a tree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

#: Parts of one in which gradients, and leaves with their sums, are counted.
UNIT, LEAF = 1 << 36, 1 << 10


@dataclass
class Trees:
    """Complete trees of one depth: features and cuts of the inner nodes, values of the leaves."""

    depth: int
    start: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            out += leaf[nodes(x, feature, cut, self.depth)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.offset)


def nodes(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """The node of a level, counted from 0, that each row comes to."""
    rows = np.arange(len(x))
    node = np.zeros(len(x), int)
    for _ in range(level):
        node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    return node - (2 ** level - 1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32) -> Trees:
    """Newton boosting of the logistic loss on quantile bins; no rows give an all-zero model."""
    model = Trees(depth)
    if not len(x) or y.min() == y.max():
        model.start = 0.0 if not len(x) else (8.0 if y[0] else -8.0)
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    rate_of_ones = y.mean()
    model.start = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    score = np.full(len(x), model.start)
    inner = 2 ** depth - 1
    for _ in range(trees):
        p = sigmoid(score)
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(x), int)
        for n in range(inner):
            here = np.flatnonzero(node == n)
            best = (1e-6, 0, np.inf, -1)
            if len(here):
                total_g, total_h = g[here].sum(), h[here].sum()
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    gs = np.bincount(binned[here, j], g[here], len(e) + 1).cumsum()[:-1]
                    hs = np.bincount(binned[here, j], h[here], len(e) + 1).cumsum()[:-1]
                    gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, e[k], k)
            feature[n], cut[n] = best[1], best[2]
            node[here] = 2 * n + 1 + (x[here, best[1]] > best[2])
        leaf_of = node - inner
        leaves = rate * np.bincount(leaf_of, g, inner + 1) / (np.bincount(leaf_of, h, inner + 1) + 1)
        score += leaves[leaf_of]
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(leaves)
    return model


def quantiles(values: np.ndarray, counts: np.ndarray, bins: int = 32) -> np.ndarray:
    """Bounds of bins with about as many rows each, from ascending values and their numbers of rows."""
    reached = np.cumsum(counts)
    asked = np.arange(1, bins) * int(reached[-1]) // bins
    return np.unique(values[np.searchsorted(reached, asked, "right")]).astype(float)


def cells(model: Trees, feature: np.ndarray, cut: np.ndarray, level: int, edges: list[np.ndarray],
          x: np.ndarray, y: np.ndarray, n: np.ndarray, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Of rows that stand for ``n`` each, of that weight: gradients and curvatures in UNITs, summed by node of the
    level of the tree that is grown, feature and bin, of which each feature has as many as the one with most."""
    p = sigmoid(model.margin(x))
    parts = [np.rint(v * weight * UNIT) * n for v in (y - p, p * (1 - p))]
    width = max(map(len, edges)) + 1
    node = nodes(x, feature, cut, level)
    out = np.zeros((2, 2 ** level, len(edges), width), np.int64)
    for j, e in enumerate(edges):
        at = node * width + np.searchsorted(e, x[:, j], "left")
        for k, part in enumerate(parts):  # sums of integers below 2^53 are exact
            out[k, :, j] = np.bincount(at, part, 2 ** level * width).reshape(-1, width)
    return out


def grow(summed: Callable[[Trees, np.ndarray, np.ndarray, int], np.ndarray], edges: list[np.ndarray],
         ones: float, zeros: float, trees: int = 40, depth: int = 3, rate: float = 0.3) -> Trees:
    """Newton boosting of the logistic loss. ``summed``: the ``cells`` of all rows for (model, feature, cut,
    level); ``ones``, ``zeros``: their weights by label. No rows give an all-zero model."""
    model = Trees(depth)
    if not ones or not zeros:
        model.start = (8.0 if ones else -8.0) if ones + zeros else 0.0
        return model
    model.start = round(float(np.log(ones / zeros)) * LEAF) / LEAF
    for _ in range(trees):
        feature, cut = np.zeros(2 ** depth - 1, int), np.full(2 ** depth - 1, np.inf)
        leaves = np.zeros(2 ** depth)
        for level in range(depth):
            sums = summed(model, feature, cut, level) / UNIT
            for n in range(2 ** level):
                g, h = sums[0, n], sums[1, n]
                total_g, total_h = g[0].sum(), h[0].sum()
                gs, hs = g.cumsum(1), h.cumsum(1)
                gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
                for j, e in enumerate(edges):
                    gain[j, len(e):] = 0
                j, k = divmod(int(gain.argmax()), gain.shape[1])
                left = (total_g, total_h)
                if gain[j, k] > 1e-6:
                    feature[2 ** level - 1 + n], cut[2 ** level - 1 + n] = j, edges[j][k]
                    left = (gs[j, k], hs[j, k])
                if level == depth - 1:
                    right = (total_g - left[0], total_h - left[1])
                    leaves[2 * n:2 * n + 2] = [rate * a / (b + 1) for a, b in (left, right)]
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(np.rint(leaves * LEAF) / LEAF)
    return model


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray, turns: int = 50, weight: np.ndarray | None = None) -> None:
    """Platt scaling on rows that the trees have not seen (Newton steps, smoothed targets); ``weight``:
    rows that each stands for."""
    platt(model, model.margin(x), y, turns, weight)


def platt(model: Trees, m: np.ndarray, y: np.ndarray, turns: int = 50, weight: np.ndarray | None = None) -> None:
    """``calibrate`` from the margins."""
    if not len(m) or y.min() == y.max():
        return
    weight = np.ones(len(m)) if weight is None else weight
    ones, zeros = weight @ y, weight @ (1 - y)
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(turns):
        p = sigmoid(a * m + b)
        w = weight * (p * (1 - p) + 1e-9)
        ga, gb = (weight * (p - target) * m).sum(), (weight * (p - target)).sum()
        haa, hab, hbb = (w * m * m).sum() + 1e-6, (w * m).sum(), w.sum() + 1e-6
        det = haa * hbb - hab * hab
        if abs(det) < 1e-12:
            break
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
        a = min(max(a, 0.05), 5.0)
    model.slope, model.offset = float(a), float(b)


def threshold(p: np.ndarray, y: np.ndarray, precision: float, weight: np.ndarray | None = None) -> float:
    """The lowest cut from which on the held-out precision is reached; above 1 if none does."""
    order = np.argsort(-p, kind="stable")
    weight = np.ones(len(p)) if weight is None else weight
    right = np.cumsum((weight * y)[order]) / np.cumsum(weight[order]) if len(p) else np.zeros(0)
    last = np.append(p[order][1:] != p[order][:-1], True) if len(p) else np.zeros(0, bool)
    good = np.flatnonzero((right >= precision) & last)
    return float(p[order][good[-1]]) if len(good) else 2.0

"""Gradient-boosted trees for a yes/no target, in numpy.

Histogram trees of fixed depth on the logistic loss: small enough to be fitted
on a bounded sample on the driver and shipped to tasks with the closure."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    base: float
    feature: np.ndarray      # (trees, 2**depth - 1)
    cut: np.ndarray          # (trees, 2**depth - 1): go right where value > cut
    leaf: np.ndarray         # (trees, 2**depth)
    scale: float = 1.0       # calibration: probability = sigmoid(scale * margin + shift)
    shift: float = 0.0


def _bins(x: np.ndarray, most: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, most + 1)[1:-1], method="lower")) for j in range(x.shape[1])]


def margins(model: Trees, x: np.ndarray) -> np.ndarray:
    depth = int(np.log2(model.leaf.shape[1]))
    out = np.full(len(x), model.base)
    rows = np.arange(len(x))
    for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
        at = np.zeros(len(x), np.int64)
        for _ in range(depth):
            at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        out += leaf[at - (len(leaf) - 1)]
    return out


def probabilities(model: Trees, x: np.ndarray) -> np.ndarray:
    if len(x) == 0:
        return np.zeros(0)
    return 1 / (1 + np.exp(-(model.scale * margins(model, x) + model.shift)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32,
        smooth: float = 1.0, least: float = 2.0) -> Trees:
    """Boost ``rounds`` trees: each level splits every node at the bin with
    the largest gain in the second-order expansion of the logistic loss."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    cuts = _bins(x, bins)
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    width = max((len(c) for c in cuts), default=0) + 1
    n_feat, inner = x.shape[1], 2 ** depth - 1
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    feature, cut = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf)
    leaf = np.zeros((rounds, inner + 1))
    rows = np.arange(len(y))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n_nodes = 2 ** level - 1, 2 ** level
            for f in range(n_feat):
                place = (at - first) * width + code[:, f]
                gs = np.bincount(place, g, n_nodes * width).reshape(n_nodes, width).cumsum(axis=1)
                hs = np.bincount(place, h, n_nodes * width).reshape(n_nodes, width).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + smooth) + (gt - gs) ** 2 / (ht - hs + smooth) - gt ** 2 / (ht + smooth)
                gain[(hs < least) | (ht - hs < least)] = 0
                gain = gain[:, : len(cuts[f])]
                best = gain.argmax(axis=1) if gain.shape[1] else np.zeros(n_nodes, np.int64)
                value = gain[np.arange(n_nodes), best] if gain.shape[1] else np.zeros(n_nodes)
                if f == 0:
                    top = np.zeros(n_nodes)
                better = value > top + 1e-9
                for k in np.flatnonzero(better):
                    feature[r, first + k], cut[r, first + k] = f, cuts[f][best[k]]
                top = np.where(better, value, top)
            at = 2 * at + 1 + (x[rows, feature[r, at]] > cut[r, at])
        gs = np.bincount(at - inner, g, inner + 1)
        hs = np.bincount(at - inner, h, inner + 1)
        leaf[r] = -rate * gs / (hs + smooth)
        margin = margin + leaf[r, at - inner]
    return Trees(base, feature, cut, leaf)


def calibrated(model: Trees, x: np.ndarray, y: np.ndarray, rounds: int = 60) -> Trees:
    """Platt scaling on rows the trees were not fitted on (Newton steps, with
    the usual smoothed targets)."""
    if len(y) == 0 or y.min() == y.max():
        return model
    m, a, b = margins(model, x), 1.0, 0.0
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(a * m + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        ga, gb = ((p - t) * m).sum() + 1e-3 * (a - 1), (p - t).sum()
        haa, hab, hbb = (w * m * m).sum() + 1e-3, (w * m).sum(), w.sum() + 1e-3
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 1.0 / max(abs(da), abs(db), 1e-9))
        a, b = max(a - step * da, 0.05), b - step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return model._replace(scale=float(a), shift=float(b))


def threshold(model: Trees, x: np.ndarray, y: np.ndarray, precision: float) -> float:
    """A probability from which on the given share of the rows is positive:
    half way from the least one that reaches it to the next below; above 1
    where none does."""
    p = probabilities(model, x)
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.ones(len(y), dtype=bool)
    last[:-1] = p[order][:-1] != p[order][1:]
    good = np.flatnonzero((hit >= precision) & last)
    if not len(good):
        return 2.0
    below = p[order][good[-1] + 1:]
    return float((p[order][good[-1]] + (below[0] if len(below) else 0.0)) / 2)

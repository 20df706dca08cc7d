"""Gradient-boosted trees for the logistic loss, on numpy. For bounded training samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """Nodes in level order; node i has children 2i + 1 (value <= cut) and 2i + 2."""

    feature: np.ndarray  # -1: a leaf
    cut: np.ndarray
    value: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        inner = self.feature >= 0
        while True:
            moving = np.flatnonzero(inner[at])
            if not len(moving):
                return at
            node = at[moving]
            right = x[moving, self.feature[node]] > self.cut[node]
            at[moving] = 2 * node + 1 + right


@dataclass(frozen=True)
class Boosted:
    base: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.value[tree.apply(x)]
        return out


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature up to ``bins`` - 1 cuts between neighbouring values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(values, np.linspace(0, 1, bins)))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 64,
    least: float = 5.0,
    ridge: float = 1.0,
    rows_per_tree: float = 1.0,
    seed: int = 0,
) -> Boosted:
    """Fit to 0/1 labels. Ties between cuts go to the first feature and cut, so it is repeatable."""
    rng = np.random.Generator(np.random.PCG64(seed))
    cuts = _cuts(x, bins)
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
    width = max((len(c) for c in cuts), default=0) + 1
    n, features = x.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if n else 0.5
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    out = []
    size = 2 ** (depth + 1) - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = y - p, np.maximum(p * (1 - p), 1e-9)
        used = np.flatnonzero(rng.random(n) < rows_per_tree) if rows_per_tree < 1 else np.arange(n)
        tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
        at = np.zeros(n, np.int64)
        tree.value[0] = rate * gradient[used].sum() / (curvature[used].sum() + ridge) if len(used) else 0.0
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            rows = used[(at[used] >= first) & (at[used] < first + count)]
            if not len(rows):
                break
            node = at[rows] - first
            best = np.full(count, 1e-6)
            split = [None] * count
            for f in range(features):
                if not len(cuts[f]):
                    continue
                cell = node * width + binned[rows, f]
                g = np.bincount(cell, gradient[rows], count * width).reshape(count, width)
                h = np.bincount(cell, curvature[rows], count * width).reshape(count, width)
                m = np.bincount(cell, minlength=count * width).reshape(count, width)
                gl, hl, ml = (a.cumsum(axis=1)[:, : len(cuts[f])] for a in (g, h, m))
                gt, ht, mt = (a.sum(axis=1)[:, None] for a in (g, h, m))
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain = np.where((ml >= least) & (mt - ml >= least), gain, -np.inf)
                k = gain.argmax(axis=1)
                top = gain[np.arange(count), k]
                for i in np.flatnonzero(top > best):
                    best[i] = top[i]
                    split[i] = (f, int(k[i]), gl[i, k[i]], hl[i, k[i]], gt[i, 0], ht[i, 0])
            for i, s in enumerate(split):
                if s is None:
                    continue
                f, k, gl, hl, gt, ht = s
                node_no = first + i
                tree.feature[node_no], tree.cut[node_no] = f, cuts[f][k]
                tree.value[2 * node_no + 1] = rate * gl / (hl + ridge)
                tree.value[2 * node_no + 2] = rate * (gt - gl) / (ht - hl + ridge)
                mine = np.flatnonzero(at == node_no)
                at[mine] = 2 * node_no + 1 + (binned[mine, f] > k)
        margin += tree.value[at]
        out.append(tree)
    return Boosted(base, out)

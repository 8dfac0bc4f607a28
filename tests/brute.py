"""A plain single-process model of the documented rules, for small inputs only."""

from __future__ import annotations

import math

import numpy as np


def total(values):
    """The sum of the values' multiples of 2^-52, without rounding until the end."""
    return sum(math.floor(v * 2.0**52) for v in values.tolist()) / 2.0**52


def best_split(x, g, h, idx, lam, gamma, min_leaf=None, min_child_weight=None):
    best = None
    for f in range(x.shape[1]):
        v = x[idx, f]
        values = np.unique(v[~np.isnan(v)])
        for a, b in zip(values[:-1], values[1:]):
            s = (a + b) / 2
            left = v <= s
            gl, hl = total(g[idx][left]), total(h[idx][left])
            gr, hr = total(g[idx][~left]), total(h[idx][~left])
            nl, nr = int(left.sum()), int((~left).sum())
            if min_leaf is not None and min(nl, nr) < min_leaf:
                continue
            if min_child_weight is not None and min(hl, hr) <= min_child_weight:
                continue
            if 0 in (hl + lam, hr + lam, hl + hr + lam):
                continue
            gain = 0.5 * (gl * gl / (hl + lam) + gr * gr / (hr + lam) - (gl + gr) ** 2 / (hl + hr + lam)) - gamma
            key = (-gain, f, s)
            if best is None or key < best[0]:
                best = (key, f, s, gain)
    return best


def grow(x, g, h, depth, lam, gamma, min_gain=None, **rules):
    nodes = {}

    def visit(node, idx, level):
        leaf = {"n": len(idx), "val": -total(g[idx]) / (total(h[idx]) + lam)}
        nodes[node] = leaf
        if len(idx) <= 1 or level >= depth:
            return
        best = best_split(x, g, h, idx, lam, gamma, **rules)
        if best is None or (min_gain is not None and not best[3] > min_gain):
            return
        _, f, s, gain = best
        leaf.update(f=f, split=s, gain=gain)
        left = x[idx, f] <= s
        visit(2 * node, idx[left], level + 1)
        visit(2 * node + 1, idx[~left], level + 1)

    visit(1, np.arange(len(x)), 0)
    return nodes


def predict(nodes, x):
    out = np.empty(len(x))
    for i, row in enumerate(x):
        node = 1
        while "f" in nodes[node]:
            node = 2 * node + (0 if row[nodes[node]["f"]] <= nodes[node]["split"] else 1)
        out[i] = nodes[node]["val"]
    return out


def fit(x, y, trees, depth, lr, lam, gamma, start=0.5, **rules):
    margin = np.full(len(x), start)
    model, losses = [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        nodes = grow(x, p - y, p * (1 - p), depth, lam, gamma, **rules)
        out = predict(nodes, x)
        margin = margin + lr * out
        model.append(nodes)
        losses.append(math.sqrt(np.mean((y - out) ** 2)))
    return model, losses


def probability(model, x, lr, start=0.0):
    margin = np.full(len(x), start)
    for nodes in model:
        margin = margin + lr * predict(nodes, x)
    return 1 / (1 + np.exp(-margin))

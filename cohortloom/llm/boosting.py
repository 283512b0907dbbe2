"""Gradient-boosted trees over a table of feature cells, compiled to one Column.

Spark counts the candidates of every combination of small-integer features; that table is bounded by the product of the
features' ranges, whatever the corpus. The trees are fitted to its weighted cells on the driver and come back as nested
CASE expressions, so scoring needs no Python.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _split(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, penalty: float):
    """A leaf value, or (feature, threshold, left, right): left has values up to the threshold."""
    g, h = grad.sum(), hess.sum()
    best = (1e-9, None)
    for f in range(x.shape[1]) if depth else ():
        for t in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= t
            a, b = grad[left].sum(), hess[left].sum()
            gain = a * a / (b + penalty) + (g - a) ** 2 / (h - b + penalty) - g * g / (h + penalty)
            if gain > best[0]:
                best = (gain, (f, int(t), left))
    if best[1] is None:
        return -g / (h + penalty)
    f, t, left = best[1]
    return f, t, _split(x[left], grad[left], hess[left], depth - 1, penalty), _split(x[~left], grad[~left], hess[~left], depth - 1, penalty)


def _value(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, t, low, high = tree
    return np.where(x[:, f] <= t, _value(low, x), _value(high, x))


def fit(x: np.ndarray, positive: np.ndarray, total: np.ndarray, rounds: int = 24, depth: int = 3, rate: float = 0.3, penalty: float = 1.0):
    """(base score, trees) of logistic boosting; ``x`` has a row of features for each cell."""
    share = (positive.sum() + 0.5) / (total.sum() + 1)
    base = float(np.log(share / (1 - share)))
    score, trees = np.full(len(x), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _split(x, total * p - positive, total * p * (1 - p), depth, penalty)
        score = score + rate * _value(tree, x)
        trees.append(tree)
    return base, trees, rate


def scores(model, x: np.ndarray) -> np.ndarray:
    base, trees, rate = model
    return base + rate * sum((_value(t, x) for t in trees), np.zeros(len(x)))


def to_column(model, features: list[Column]) -> Column:
    base, trees, rate = model

    def node(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        f, t, low, high = tree
        return F.when(features[f] <= t, node(low)).otherwise(node(high))

    out = F.lit(base)
    for tree in trees:
        out = out + node(tree) * rate
    return out


def threshold(score: np.ndarray, positive: np.ndarray, total: np.ndarray, precision: float) -> float:
    """The lowest score from which on the cells are right with at least that precision; infinite if there is none."""
    best, hits, n = float("inf"), 0, 0
    order = np.argsort(-score, kind="stable")
    for k, i in enumerate(order):
        hits, n = hits + positive[i], n + total[i]
        ends = k + 1 == len(order) or score[order[k + 1]] < score[i]
        if ends and hits / n >= precision:
            best = float(score[i])
    return best

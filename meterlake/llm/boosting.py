"""Gradient boosting on a table of counts: rows of small numbers, hits and misses."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Row = tuple[tuple[int, ...], float, float]  # feature values, hits, misses


@dataclass(frozen=True)
class Tree:
    """`feature` <= `cut` decides between two subtrees; a leaf has its value only."""

    value: float = 0.0
    feature: int = -1
    cut: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def score(self, x: tuple[int, ...]) -> float:
        if self.low is None:
            return self.value
        return (self.low if x[self.feature] <= self.cut else self.high).score(x)

    def column(self, names: list[str]) -> Column:
        if self.low is None:
            return F.lit(float(self.value))
        return F.when(
            F.col(names[self.feature]) <= self.cut, self.low.column(names)
        ).otherwise(self.high.column(names))


@dataclass(frozen=True)
class Boosted:
    """Sum of trees and a base value, in log odds."""

    base: float
    trees: list[Tree]

    def score(self, x: tuple[int, ...]) -> float:
        return _odds(self.base + sum(t.score(x) for t in self.trees))

    def column(self, names: list[str]) -> Column:
        """The same as an SQL expression over columns `names`."""
        total = F.lit(float(self.base))
        for tree in self.trees:
            total = total + tree.column(names)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _odds(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _grow(rows: list, depth: int, ridge: float) -> Tree:
    """`rows`: (features, gradient, curvature). The split that gains most, greedily."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = Tree(value=g / (h + ridge))
    if not depth or len(rows) < 2:
        return leaf
    best, at = 1e-6, None
    for f in range(len(rows[0][0])):
        sums: dict[int, list[float]] = {}
        for x, a, b in rows:
            cell = sums.setdefault(x[f], [0.0, 0.0])
            cell[0] += a
            cell[1] += b
        gl = hl = 0.0
        for value in sorted(sums)[:-1]:
            gl += sums[value][0]
            hl += sums[value][1]
            gain = (
                gl * gl / (hl + ridge)
                + (g - gl) ** 2 / (h - hl + ridge)
                - g * g / (h + ridge)
            )
            if gain > best:
                best, at = gain, (f, value)
    if at is None:
        return leaf
    f, cut = at
    return Tree(
        feature=f,
        cut=cut,
        low=_grow([r for r in rows if r[0][f] <= cut], depth - 1, ridge),
        high=_grow([r for r in rows if r[0][f] > cut], depth - 1, ridge),
    )


def boost(
    rows: list[Row], rounds: int = 12, depth: int = 3, rate: float = 0.5, ridge: float = 1.0
) -> Boosted:
    """Logistic loss, one tree a round, fitted by gradient and curvature."""
    hits, misses = sum(r[1] for r in rows), sum(r[2] for r in rows)
    base = math.log((hits + 1) / (misses + 1))
    values = [base] * len(rows)
    trees: list[Tree] = []
    for _ in range(rounds if hits and misses else 0):
        pulls = []
        for (x, up, down), value in zip(rows, values, strict=True):
            p = _odds(value)
            pulls.append((x, up - (up + down) * p, (up + down) * p * (1 - p)))
        tree = _shrunk(_grow(pulls, depth, ridge), rate)
        trees.append(tree)
        values = [
            v + tree.score(x) for (x, _, _), v in zip(rows, values, strict=True)
        ]
    return Boosted(base, trees)


def _shrunk(tree: Tree, rate: float) -> Tree:
    if tree.low is None:
        return Tree(value=tree.value * rate)
    low, high = _shrunk(tree.low, rate), _shrunk(tree.high, rate)
    return Tree(feature=tree.feature, cut=tree.cut, low=low, high=high)


def calibrated_threshold(
    scored: list[tuple[float, float, float]], precision: float, least: float
) -> float | None:
    """The lowest score from which on hits are at least `precision` of all.

    `scored` has (score, hits, misses) of rows not trained on. None if no score does,
    or fewer than `least` rows are above it.
    """
    found, up, down = None, 0.0, 0.0
    ranked = sorted(scored, reverse=True)
    for i, (score, hits, misses) in enumerate(ranked):
        up += hits
        down += misses
        last = i + 1 == len(ranked) or ranked[i + 1][0] < score
        if last and up + down >= least and up >= precision * (up + down):
            found = score
    return found

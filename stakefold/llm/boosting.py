"""Small gradient-boosted trees: in numpy for rows in hand, in passes over a Spark table for any number of rows.

A pass adds up the gradients of one level of a tree by node, feature and bin inside the tasks; the driver gets these sums
and chooses the splits.  Gradients are whole multiples of 2^-30, so sums are exact and do not depend on the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 2.0 ** 30


@dataclass
class Tree:
    """A complete binary tree: at every inner node a feature and the largest value that goes left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        depth = len(self.value).bit_length() - 1
        at = np.zeros(len(x), np.int64)
        for _ in range(depth):
            right = x[np.arange(len(x)), self.feature[at]] > self.cut[at]
            at = 2 * at + 1 + right
        return self.value[at - len(self.feature)]


def grow(x: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, ridge: float) -> Tree:
    """Second-order splits by histogram, level by level."""
    inner = 2 ** depth - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    at = np.zeros(len(x), np.int64)
    bins = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]
    for node in range(inner):
        rows = np.flatnonzero(at == node)
        best = 1e-6
        if len(rows):
            g, h = gradient[rows].sum(), hessian[rows].sum()
            for j, c in enumerate(cuts):
                if len(c) == 0:
                    continue
                gl = np.cumsum(np.bincount(bins[j][rows], gradient[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(bins[j][rows], hessian[rows], len(c) + 1))[:-1]
                gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, feature[node], cut[node] = gain[k], j, c[k]
            at[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    leaves = at - inner
    g = np.bincount(leaves, gradient, inner + 1)
    h = np.bincount(leaves, hessian, inner + 1)
    return Tree(feature, cut, -g / (h + ridge))


@dataclass
class Boosted:
    start: float
    rate: float
    trees: list[Tree]

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += self.rate * tree.predict(x)
        return 1 / (1 + np.exp(-total))


def cuts_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Where to cut a feature of these distinct values, in ascending order."""
    middles = (values[1:] + values[:-1]) / 2
    return middles if len(middles) <= bins else np.unique(np.quantile(values, np.linspace(0, 1, bins + 2)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 24,
        ridge: float = 1.0) -> Boosted:
    """Boosted trees for the logistic loss."""
    cuts = [cuts_of(np.unique(x[:, j]), bins) for j in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), rate, [])
    total = np.full(len(x), model.start)
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-total))
        tree = grow(x, cuts, chance - y, chance * (1 - chance), depth, ridge)
        model.trees.append(tree)
        total += rate * tree.predict(x)
    return model


def rows_of(column: pa.Array) -> np.ndarray:
    """An array column of lists of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def level_sums(rows: DataFrame, model: Boosted, feature: np.ndarray, cut: np.ndarray, level: int, cuts: list[np.ndarray]) -> np.ndarray:
    """Sums of gradients and hessians by node of a level, feature and bin, over all of (label, n, x)."""
    nodes, width = 2 ** level, max(map(len, cuts)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, nodes, len(cuts), width))
        for batch in batches:
            y, n, x = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), rows_of(batch.column(2)))
            chance = model.probability(x)
            at = np.zeros(len(x), np.int64)
            for _ in range(level):
                at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > cut[at])
            at -= nodes - 1
            for i, part in enumerate((chance - y, chance * (1 - chance))):
                whole = np.rint(part * UNIT) * n
                for j, c in enumerate(cuts):
                    found = np.bincount(at * width + np.searchsorted(c, x[:, j], side="left"), whole, nodes * width)
                    sums[i, :, j] += found.reshape(nodes, width)
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel()], pa.list_(pa.float64()))], ["sums"])

    found = rows.select("label", "n", "x").mapInArrow(run, "sums array<double>").toArrow()["sums"].combine_chunks()
    return rows_of(found).sum(axis=0).reshape(2, nodes, len(cuts), width) / UNIT


def grow_on(rows: DataFrame, model: Boosted, cuts: list[np.ndarray], depth: int, ridge: float) -> Tree:
    """A tree as of ``grow``, a pass over the table for each level."""
    inner = 2 ** depth - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    value = np.zeros(inner + 1)
    for level in range(depth):
        sums = level_sums(rows, model, feature, cut, level, cuts)
        for i in range(2 ** level):
            node, best = 2 ** level - 1 + i, 1e-6
            g, h = sums[0, i, 0].sum(), sums[1, i, 0].sum()
            left = (g, h)
            for j, c in enumerate(cuts):
                if len(c) == 0:
                    continue
                gl, hl = np.cumsum(sums[:, i, j, :len(c)], axis=1)
                gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, feature[node], cut[node], left = gain[k], j, c[k], (gl[k], hl[k])
            if level == depth - 1:
                value[2 * i] = -left[0] / (left[1] + ridge)
                value[2 * i + 1] = -(g - left[0]) / (h - left[1] + ridge)
    return Tree(feature, cut, value)


def fit_on(rows: DataFrame, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 24, ridge: float = 1.0) -> Boosted:
    """Boosted trees as of ``fit`` on all rows of a stored table: label (0 or 1), n (how often) and x (the features).  The
    driver holds the distinct values of each feature."""
    total = rows.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("ones")).first()
    values = rows.select(F.posexplode("x").alias("j", "value")).distinct().groupBy("j").agg(
        F.sort_array(F.collect_list("value")).alias("found")).orderBy("j").collect()
    cuts = [cuts_of(np.array(r["found"]), bins) for r in values]
    share = np.clip(total["ones"] / total["n"], 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), rate, [])
    for _ in range(rounds):
        model.trees.append(grow_on(rows, model, cuts, depth, ridge))
    return model

"""Boosted trees for counts: Poisson objective, log link.

Features are cut into at most ``BINS`` bins, and rows that fall into the same bins become one cell
with their number and the sum of their counts, which is all that the objective asks of them.
For each level of a tree, tasks evaluate the trees so far on their cells and add up gradients and
curvatures by node, feature and bin; Spark sums these histograms, whose size depends on the
bins alone, and the driver picks the splits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.session import remove_folders, scratch

# Parameters of the trees.
DEPTH, ROUNDS, RATE = 3, 100, 0.1
BINS = 64
# Added to the curvature of a leaf; the least gain of a split.
PENALTY, LEAST_GAIN = 1.0, 1e-9


class PoissonTrees:
    """A fitted model: ``cuts`` by feature, the logarithm ``base`` of the mean, and trees.

    A tree is three lists over the nodes of a complete binary tree, 0 the root and 2 n + 1, 2 n + 2
    the children of n: the feature that splits (-1 in a leaf), the place of its cut, the value.
    """

    def __init__(self, features: list[str], cuts: list[list[float]], base: float):
        self.features, self.cuts, self.base = features, cuts, base
        self.trees: list[tuple[list[int], list[int], list[float]]] = []

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``df`` with the expected count. A missing value goes the way of large ones."""

        def sql(tree: tuple, n: int = 0) -> str:
            split, cut, value = tree
            if split[n] < 0:
                return f"{value[n]!r}D"
            at = f"CAST(`{self.features[split[n]]}` AS DOUBLE) <= {self.cuts[split[n]][cut[n]]!r}D"
            return f"IF({at}, {sql(tree, 2 * n + 1)}, {sql(tree, 2 * n + 2)})"

        parts = [F.expr(sql(tree)) for tree in self.trees]
        total = F.lit(float(self.base))
        if parts:
            total = total + F.aggregate(F.array(*parts), F.lit(0.0), lambda a, b: a + b)
        return df.withColumn(prediction, F.exp(total))


def place(tree: tuple, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node that each row of ``bins`` comes to after at most ``depth`` splits."""
    split, cut = np.array(tree[0]), np.array(tree[1])
    at = np.zeros(len(bins), np.int64)
    for _ in range(depth):
        feature = split[at]
        right = bins[np.arange(len(bins)), np.maximum(feature, 0)] > cut[at]
        at = np.where(feature < 0, at, 2 * at + 1 + right)
    return at


def fit(
    df: DataFrame, label: str, features: list[str], rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE, bins: int = BINS
) -> PoissonTrees:
    """Trees on the rows of ``df`` that have a count."""
    spark = df.sparkSession
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    )
    inputs = [f"_x{i}" for i in range(len(features))]
    found = rows.approxQuantile(inputs, [i / bins for i in range(1, bins)], 1 / (4 * bins))
    cuts = [sorted({float(x) for x in q if math.isfinite(x)}) for q in found]
    binned = []
    for x, at in zip(inputs, cuts):
        known = ", ".join(f"{c!r}D" for c in at)
        below = f"size(filter(array({known}), c -> c < {x}))" if at else "0"
        binned.append(F.expr(f"IF({x} IS NULL OR isnan({x}), {len(at)}, {below}) AS {x}"))
    path = scratch(spark, "cells")
    rows.select("_y", *binned).groupBy(*inputs).agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s")).write.parquet(path)
    cells = spark.read.parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
    n, total = cells.agg(F.sum("_n"), F.sum("_s")).first()
    model = PoissonTrees(features, cuts, math.log(total / n) if n and total else -math.inf if n else 0.0)
    if n and total:
        width = max(map(len, cuts), default=0) + 1
        for _ in range(rounds):
            model.trees.append(_tree(cells, model, inputs, width, depth, rate))
    cells.unpersist()
    remove_folders(spark, [path])
    return model


def _tree(cells: DataFrame, model: PoissonTrees, inputs: list[str], width: int, depth: int, rate: float) -> tuple:
    size = 2 ** (depth + 1) - 1
    tree = ([-1] * size, [0] * size, [0.0] * size)
    for level in range(depth):
        first = 2**level - 1
        sums = _histograms(cells, model, tree, inputs, width, level)
        for node in range(first, 2 * first + 1):
            if level and tree[0][(node - 1) // 2] < 0:
                continue
            g, h = sums[0, node - first], sums[1, node - first]
            all_g, all_h = g[0].sum(), h[0].sum()
            if not level:
                tree[2][0] = -rate * all_g / (all_h + PENALTY)
            best = (LEAST_GAIN, -1, 0)
            for f, cuts in enumerate(model.cuts):
                left_g, left_h = np.cumsum(g[f])[: len(cuts)], np.cumsum(h[f])[: len(cuts)]
                gain = left_g**2 / (left_h + PENALTY) + (all_g - left_g) ** 2 / (all_h - left_h + PENALTY) - all_g**2 / (all_h + PENALTY)
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (gain[at], f, at)
                    values = left_g[at], left_h[at]
            if best[1] >= 0:
                tree[0][node], tree[1][node] = best[1], best[2]
                left_g, left_h = values
                tree[2][2 * node + 1] = float(-rate * left_g / (left_h + PENALTY))
                tree[2][2 * node + 2] = float(-rate * (all_g - left_g) / (all_h - left_h + PENALTY))
    return tree


def _histograms(cells: DataFrame, model: PoissonTrees, tree: tuple, inputs: list[str], width: int, level: int) -> np.ndarray:
    """Gradients and curvatures by node of the level, feature and bin."""
    base, trees, nodes = model.base, list(model.trees), 2**level

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, nodes, len(inputs), width))
        for batch in batches:
            bins = np.stack([np.asarray(batch.column(x)) for x in inputs], axis=1).astype(np.int64)
            n, s = np.asarray(batch.column("_n")), np.asarray(batch.column("_s"))
            margin = np.full(len(bins), base)
            for grown in trees:
                margin += np.array(grown[2])[place(grown, bins, len(grown[0]).bit_length())]
            mean = n * np.exp(margin)
            at = place(tree, bins, level) - (nodes - 1)
            here = at >= 0
            for f in range(len(inputs)):
                flat = at[here] * width + bins[here, f]
                for side, values in enumerate((mean - s, mean)):
                    held[side, :, f] += np.bincount(flat, values[here], nodes * width).reshape(nodes, width)
        node, feature, bin = np.nonzero(held[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int32)) for x in (node, feature, bin)] + [pa.array(held[i, node, feature, bin]) for i in (0, 1)],
            ["node", "feature", "bin", "g", "h"],
        )

    parts = cells.mapInArrow(add, "node int, feature int, bin int, g double, h double")
    sums = np.zeros((2, nodes, len(inputs), width))
    for r in parts.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
        sums[:, r["node"], r["feature"], r["bin"]] = r["g"], r["h"]
    return sums

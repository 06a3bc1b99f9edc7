"""Gradient boosted trees of depth two for integer features, scored as a Spark expression.

Rows with equal features and label are one row that counts them. Few of them are fitted on the driver, any number by Spark jobs. Both add gradients as whole
numbers, so that no order of rows changes a sum, and give the same trees."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RATE = 0.3
ROUNDS = 30
DEPTH = 2
SCALE = 2**24  # gradients are whole multiples of 1 / SCALE


@dataclass
class Split:
    """``value`` of a leaf, or: left where feature <= cut."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    left: Split | None = None
    right: Split | None = None


# Of each feature its values in order, and for each value the sums of gradients and curvatures.
Sums = list[tuple[np.ndarray, np.ndarray, np.ndarray]]
# The way to a node: feature, cut, whether it goes left.
Path = tuple[tuple[int, float, bool], ...]


def _leaf(g: float, h: float) -> float:
    return RATE * float(g) / (float(h) + 1.0)


def _best(sums: Sums) -> tuple[int, float, Split, Split] | None:
    """The split that gains most, with its leaves."""
    found, most = None, 1e-6
    for f, (values, g, h) in enumerate(sums):
        if len(values) < 2:
            continue
        gl, hl = np.cumsum(g)[:-1] / SCALE, np.cumsum(h)[:-1] / SCALE
        gr, hr = g.sum() / SCALE - gl, h.sum() / SCALE - hl
        gain = gl**2 / (hl + 1.0) + gr**2 / (hr + 1.0) - (g.sum() / SCALE) ** 2 / (h.sum() / SCALE + 1.0)
        k = int(np.argmax(gain))
        if gain[k] > most:
            most = float(gain[k])
            found = f, float((values[k] + values[k + 1]) / 2), Split(value=_leaf(gl[k], hl[k])), Split(value=_leaf(gr[k], hr[k]))
    return found


def _grow(sums: Callable[[list[Path]], list[Sums]]) -> Split:
    """A tree from ``sums`` of the nodes of a level, asked for once a level."""
    root, level = Split(), [()]
    nodes = [root]
    for depth in range(DEPTH):
        below, paths = [], []
        for node, path, own in zip(nodes, level, sums(level)):
            if depth == 0:
                node.value = _leaf(own[0][1].sum() / SCALE, own[0][2].sum() / SCALE)
            split = _best(own)
            if split:
                node.value, (node.feature, node.cut, node.left, node.right) = 0.0, split
                below += [node.left, node.right]
                paths += [(*path, (node.feature, node.cut, left)) for left in (True, False)]
        nodes, level = below, paths
        if not nodes:
            break
    return root


def _values(tree: Split, x: np.ndarray) -> np.ndarray:
    if tree.feature < 0:
        return np.full(len(x), tree.value)
    return np.where(x[:, tree.feature] <= tree.cut, _values(tree.left, x), _values(tree.right, x))


Model = tuple[float, list[Split]]


def _boosted(positive: float, total: float, rounds: int, sums: Callable[[Model, list[Path]], list[Sums]]) -> Model:
    """Start value and trees for the logistic loss."""
    share = (positive + 1.0) / (total + 2.0)
    model = (math.log(share / (1 - share)), [])
    for _ in range(rounds):
        model[1].append(_grow(lambda level: sums(model, level)))
    return model


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, n: np.ndarray | None = None) -> Model:
    """A model of rows that stand for ``n`` each (one, if not given)."""
    n = np.ones(len(y), dtype=np.int64) if n is None else n
    coded = [np.unique(column, return_inverse=True) for column in x.T]

    def sums(model: Model, level: list[Path]) -> list[Sums]:
        p = 1 / (1 + np.exp(-margins(model, x)))
        g, h = (np.floor(v * SCALE + 0.5).astype(np.int64) * n for v in (y - p, p * (1 - p)))
        out = []
        for path in level:
            rows = np.ones(len(y), dtype=bool)
            for feature, cut, left in path:
                rows &= (x[:, feature] <= cut) == left
            own = []
            for values, at in coded:
                total = np.zeros((3, len(values)), dtype=np.int64)
                for part, what in zip(total, (1, g[rows], h[rows])):
                    np.add.at(part, at[rows], what)
                own.append((values[total[0] > 0], *total[1:, total[0] > 0]))
            out.append(own)
        return out

    return _boosted(float((y * n).sum()), float(n.sum()), rounds, sums)


def fit_spread(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """``fit`` of any number of rows ``x`` (integers), ``y``, ``n``: a job for each level of a tree, of which a row for each node, feature and value comes
    to the driver."""
    feature = lambda i: F.get("x", F.lit(i))

    def sums(model: Model, level: list[Path]) -> list[Sums]:
        p = 1 / (1 + F.exp(-F.col("margin")))
        node = F.lit(None).cast("int")
        for i, path in enumerate(level):
            inside = F.lit(True)
            for f, cut, left in path:
                inside &= (feature(f) <= cut) == left
            node = F.when(inside, i).otherwise(node)
        whole = lambda v: F.floor(v * SCALE + 0.5) * F.col("n")
        now = rows.withColumn("margin", expression(model, feature))
        now = now.select(node.alias("node"), whole(F.col("y") - p).alias("g"), whole(p * (1 - p)).alias("h"), F.posexplode("x").alias("f", "v"))
        found = now.where("node is not null").groupBy("node", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        own = [defaultdict(list) for _ in level]
        for r in sorted(found, key=lambda r: r["v"]):
            own[r["node"]][r["f"]].append((r["v"], r["g"], r["h"]))
        return [[tuple(np.array(of[f], dtype=np.int64).T) for f in sorted(of)] for of in own]

    total = rows.agg(F.sum(F.col("y") * F.col("n")), F.sum("n")).first()
    return _boosted(float(total[0]), float(total[1]), rounds, sums)


def margins(model: tuple[float, list[Split]], x: np.ndarray) -> np.ndarray:
    """Summed in the order of ``expression``, so that a row at a threshold is on the same side of it in both."""
    total = np.full(len(x), model[0])
    for tree in model[1]:
        total = total + _values(tree, x)
    return total


def calibrated(scores: np.ndarray, y: np.ndarray, precision: float, least: int, n: np.ndarray | None = None) -> float:
    """Smallest score from which at least ``precision`` of at least ``least`` rows are positive; infinite if there is none. A row stands for ``n``."""
    n = np.ones(len(y), dtype=np.int64) if n is None else n
    order = np.argsort(-scores, kind="stable")
    hits, count = np.cumsum((y * n)[order]), np.cumsum(n[order])
    last = np.append(scores[order][1:] < scores[order][:-1], True) if len(y) else np.zeros(0, dtype=bool)
    good = np.flatnonzero((hits >= precision * count) & (count >= least) & last)
    return float(scores[order][good[-1]]) if len(good) else math.inf


def calibrated_spread(rows: DataFrame, model: Model, precision: float, least: int) -> float:
    """``calibrated`` of any number of rows ``x``, ``y``, ``n``: running sums within ranges of scores, after those of the ranges above."""
    scored = rows.select(expression(model, lambda i: F.get("x", F.lit(i))).alias("s"), "n", (F.col("y") * F.col("n")).alias("hits"))
    ranges = scored.groupBy("s").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).repartitionByRange(F.desc("s"))
    ranges = ranges.withColumn("part", F.spark_partition_id()).checkpoint()
    parts = ranges.groupBy("part").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))  # a row for each range
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "hits")])
    to_here = Window.partitionBy("part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    sums = ranges.join(F.broadcast(parts), "part").select("s", *[(F.sum(c).over(to_here) + F.col(f"{c}_above")).alias(c) for c in ("n", "hits")])
    good = sums.where((F.col("hits") >= precision * F.col("n")) & (F.col("n") >= least)).agg(F.min("s")).first()[0]
    return math.inf if good is None else good


def expression(model: tuple[float, list[Split]], feature: Callable[[int], Column]) -> Column:
    """The margin as nested conditions on ``feature(i)``."""
    def of(tree: Split) -> Column:
        if tree.feature < 0:
            return F.lit(tree.value)
        return F.when(feature(tree.feature) <= tree.cut, of(tree.left)).otherwise(of(tree.right))

    out = F.lit(model[0])
    for tree in model[1]:
        out = out + of(tree)
    return out


def matrix(rows: Sequence[Sequence[float]], width: int) -> np.ndarray:
    return np.array(rows, dtype=np.float64).reshape(-1, width)

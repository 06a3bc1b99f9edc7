"""Vantage-point trees over 64-bit fingerprints under the Hamming distance.

A node has a vantage point ``v`` and a radius ``r``. Points with ``d(x, v) <= r`` go inside, the others outside; those
outside with ``d(x, v) <= r + reach`` go inside as well. Two points at most ``reach`` apart are then together on one side:
if one is inside, the triangle inequality puts the other within ``r + reach``. So every close pair meets in a leaf, and a
search never has to look across leaves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

CANDIDATES = 12  # vantage points tried for a node
LEAF = 1024  # points compared all with all
USEFUL = 0.9  # a split must save at least a tenth of the comparisons


@dataclass
class Tree:
    """Nodes in arrays: vantage point, radius, children; a leaf has ``inside`` -1 and its cell number as ``outside``."""

    vantage: list[int] = field(default_factory=list)
    radius: list[int] = field(default_factory=list)
    inside: list[int] = field(default_factory=list)
    outside: list[int] = field(default_factory=list)
    cells: int = 0

    def add(self) -> int:
        for column in (self.vantage, self.radius, self.inside, self.outside):
            column.append(-1)
        return len(self.vantage) - 1


def distances(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to)


def best_split(points: np.ndarray, reach: int) -> tuple[np.uint64, int, float]:
    """Vantage point and radius with the fewest comparisons left, and their share of all."""
    n = len(points)
    best = (points[0], 64, 1.0)
    for v in points[:: max(1, n // CANDIDATES)][:CANDIDATES]:
        within = np.cumsum(np.bincount(distances(points, v), minlength=65 + reach)) / n
        cost = within[reach : 64 + reach] ** 2 + (1 - within[:64]) ** 2
        r = int(np.argmin(cost))
        if cost[r] < best[2]:
            best = (v, r, float(cost[r]))
    return best


def build(sample: np.ndarray, least: int, reach: int) -> Tree:
    """A tree whose leaves hold about ``least`` sample points or cannot be split with profit."""
    tree = Tree()
    todo = [(tree.add(), sample)]
    while todo:
        node, points = todo.pop()
        v, r, share = best_split(points, reach) if len(points) >= 2 * least else (0, 0, 1.0)
        if share > USEFUL:
            tree.outside[node] = tree.cells
            tree.cells += 1
            continue
        d = distances(points, v)
        tree.vantage[node], tree.radius[node] = int(v), r
        tree.inside[node], tree.outside[node] = tree.add(), tree.add()
        todo.append((tree.inside[node], points[d <= r + reach]))
        todo.append((tree.outside[node], points[d > r]))
    return tree


def route(tree: Tree, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and index of each point, once for each cell it goes to."""
    cells, rows = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not at.size:
            continue
        if tree.inside[node] < 0:
            cells.append(np.full(at.size, tree.outside[node], dtype=np.int32))
            rows.append(at)
            continue
        d = distances(points[at], np.uint64(tree.vantage[node]))
        todo.append((tree.inside[node], at[d <= tree.radius[node] + reach]))
        todo.append((tree.outside[node], at[d > tree.radius[node]]))
    return np.concatenate(cells), np.concatenate(rows)


class _Sets:
    """Disjoint sets over 0..n-1, whole arrays at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, at: np.ndarray) -> np.ndarray:
        root = self.parent[at]
        while True:
            up = self.parent[root]
            if np.array_equal(up, root):
                break
            root = up
        self.parent[at] = root
        return root

    def unite(self, at: np.ndarray) -> None:
        roots = np.unique(self.find(at))
        self.parent[roots] = roots[0]


def _compare_all(points: np.ndarray, at: np.ndarray, sets: _Sets, reach: int) -> None:
    close = np.bitwise_count(points[at][:, None] ^ points[at][None, :]) <= reach
    waiting = close.sum(axis=1) > 1
    while waiting.any():
        group = np.zeros(len(at), dtype=bool)
        front = np.zeros(len(at), dtype=bool)
        front[np.argmax(waiting)] = True
        while front.any():
            group |= front
            front = close[front].any(axis=0) & ~group
        waiting &= ~group
        sets.unite(at[group])


def _compare_rest(points: np.ndarray, at: np.ndarray, sets: _Sets, reach: int) -> None:
    """All points outside the largest set against all points; links inside one set change nothing."""
    roots = sets.find(at)
    names, counts = np.unique(roots, return_counts=True)
    rest = at[roots != names[np.argmax(counts)]]
    rows = max(1, (1 << 22) // len(at))
    for i in range(0, len(rest), rows):
        part = rest[i : i + rows]
        close = np.bitwise_count(points[part][:, None] ^ points[at][None, :]) <= reach
        labels = sets.find(at)
        for j in np.flatnonzero(close.sum(axis=1) > 1):
            near = np.unique(labels[close[j]])
            if len(near) > 1:
                sets.unite(near)


def forest(points: np.ndarray, reach: int, leaf: int = LEAF) -> np.ndarray:
    """For each of the distinct ``points`` the index of a root: equal roots where a chain of close pairs leads over.

    Works down a tree built on the way. A vantage point takes all points in reach of it into its set at once, and a node whose
    points are all in one set is finished, so a dense group costs no more than a few passes over it.
    """
    sets = _Sets(len(points))
    todo = [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) < 2 or len(np.unique(sets.find(at))) == 1:
            continue
        if len(at) <= leaf:
            _compare_all(points, at, sets, reach)
            continue
        v, r, share = best_split(points[at], reach)
        if share > USEFUL:
            for star in points[at[:: max(1, len(at) // CANDIDATES)]]:
                sets.unite(at[distances(points[at], star) <= reach])
            _compare_rest(points, at, sets, reach)
            continue
        d = distances(points[at], v)
        sets.unite(at[d <= reach])
        todo.append(at[d <= r + reach])
        todo.append(at[d > r])
    return sets.find(np.arange(len(points)))

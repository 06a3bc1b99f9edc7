"""Connected components of an edge list, by union-find inside partitions and stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import shared_folder


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's edges: a tree edge to the smallest node for each node that has edges here."""
    parent: dict = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    kind = None
    for batch in batches:
        kind = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(a), find(b)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    if parent:
        pairs = [(x, r) for x in parent if (r := find(x)) != x]
        for at in range(0, len(pairs), 10_000):
            part = pairs[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], type=kind.field(i).type) for i in (0, 1)], schema=kind)


FEW_EDGES = 200_000


def components(edges: DataFrame, max_rounds: int = 100, few: int = FEW_EDGES) -> DataFrame:
    """``node, component`` (smallest node reachable) for each node of the edges ``a, b``.

    Each partition first reduces its edges to a forest, which is at most one edge for each node in it. At most ``few`` edges left are
    finished by union-find in one task. Of more, large and small stars alternate: every node's greater neighbours are linked to its
    smallest neighbour, then its smaller ones; the number of rounds grows with the logarithm of the longest path. Both give the same
    rows. Each round is checkpointed.
    """
    shared_folder(edges.sparkSession)
    edges = edges.select("a", "b").where(F.col("a") != F.col("b"))
    tree = edges.mapInArrow(_forest, edges.schema).checkpoint()
    if tree.count() <= few:
        tree = tree.repartition(1).mapInArrow(_forest, edges.schema).checkpoint()
        return _named(tree)
    print_of = None
    for _ in range(max_rounds):
        both = tree.union(tree.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct().checkpoint()
        floor = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(floor.select("a", F.col("m").alias("b")))
        tree = small.where("a != b").distinct().checkpoint()
        state = tree.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == print_of:
            return _named(tree)
        print_of = state
    raise RuntimeError("components did not settle")


def _named(tree: DataFrame) -> DataFrame:
    leaves = tree.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(tree.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Ranked lexical search of many queries at once, with common subexpressions evaluated once.

A score is a sum over the terms of an item, so sums over term sets that several items share need to be taken once for each
document. ``sharing_plan`` mines them: terms that occur in exactly the same items form an *atom*; items are then written
as sequences of atoms, the most shared atoms first, and neighbours that follow each other in two or more items are
joined to a new node, round after round. The result is a directed acyclic graph: atoms, sums of two nodes, items.

1. ``matched`` reads the texts once and keeps each document's length and its counts of the items' terms, as a table
   in the shared folder. Number and length of documents and document frequencies come from it.
2. Each task fills the atoms' accumulators for a block of documents, adds up the graph level by level, and keeps
   the best ``k`` documents of each item. Only those are shuffled.

Items are taken in blocks of about ``POSTINGS`` (item, term) pairs, by hash of their id; each block's terms and graph are sent to
the tasks, and each block is one pass over the documents. Nothing else is sent, whatever the size of either table.

Defined results: NULL and empty texts have no term; they count neither as documents nor in lengths, and items without terms
get no row. Item rows of one id are one item with the terms of all; NULL is an id. Document rows of one id are documents of their own.
Equal scores go by ascending id, NULL last. Empty tables give no row. Document ids are integers (anything else is cast to
BIGINT). Texts are read whole, however long. Further columns of the inputs are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from corpusmill.llm.decontamination import normalised
from corpusmill.llm.plainwords import texts, words_of
from corpusmill.session import scratch_folder, shared_folder

POSTINGS = 100_000
_CELLS = 1 << 21  # accumulators held at a time


@dataclass
class Plan:
    """``atom`` of each term; ``sums[level]`` are rows (node, left, right); ``items`` the nodes that add up to each item."""

    atom: np.ndarray
    atoms: int
    nodes: int
    sums: list[np.ndarray]
    items: list[np.ndarray]

    @property
    def additions(self) -> int:
        """Additions of accumulators for each document."""
        return sum(len(level) for level in self.sums) + sum(len(nodes) - 1 for nodes in self.items if len(nodes))


def sharing_plan(items: list[list[int]], terms: int) -> Plan:
    """The graph for ``items``, each a list of distinct term numbers below ``terms``."""
    holders = defaultdict(list)
    for i, members in enumerate(items):
        for t in members:
            holders[t].append(i)
    atom_of, shared_by = {}, []
    atom = np.zeros(terms, dtype=np.int64)
    for t in sorted(holders):
        key = tuple(holders[t])
        if key not in atom_of:
            atom_of[key] = len(shared_by)
            shared_by.append(len(key))
        atom[t] = atom_of[key]
    rows = [sorted({int(atom[t]) for t in members}, key=lambda a: (-shared_by[a], a)) for members in items]
    nodes, sums = len(shared_by), []
    while True:
        follow = Counter(pair for row in rows for pair in set(zip(row, row[1:])))
        shared = {pair: n for pair, n in follow.items() if n > 1}
        if not shared:
            break
        made: dict[tuple[int, int], int] = {}
        rows = [_joined(row, shared, made, nodes) for row in rows]
        sums.append(np.array([(node, *pair) for pair, node in made.items()], dtype=np.int64))
        nodes += len(made)
    return Plan(atom, len(shared_by), nodes, sums, [np.array(row, dtype=np.int64) for row in rows])


def _joined(row: list[int], shared: dict[tuple[int, int], int], made: dict[tuple[int, int], int], first: int) -> list[int]:
    """``row`` with shared neighbours joined, the more often shared pair first."""
    taken, joins = set(), {}
    pairs = [(row[i], row[i + 1]) for i in range(len(row) - 1)]
    for i in sorted((i for i, p in enumerate(pairs) if p in shared), key=lambda i: (-shared[pairs[i]], pairs[i])):
        if i not in taken and i + 1 not in taken:
            taken |= {i, i + 1}
            joins[i] = made.setdefault(pairs[i], first + len(made))
    return [joins.get(i, row[i]) for i in range(len(row)) if i in joins or i not in taken]


def _matched(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    number = {term.encode(): i for i, term in enumerate(shared.value)}
    for batch in batches:
        lengths, ends, terms, counts = [], [0], [], []
        for raw in texts(batch.column(1)):
            words = words_of(raw)
            found = Counter(i for i in map(number.get, words) if i is not None)
            lengths.append(len(words))
            terms.extend(found)
            counts.extend(found.values())
            ends.append(len(terms))
        at = pa.array(ends, type=pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(x, type=pa.int32())) for x in (terms, counts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, type=pa.int64()), *lists], names=["id", "n", "terms", "counts"])


class _Best:
    """The best ``k`` documents of each item so far."""

    def __init__(self, k: int, items: int):
        self.k = k
        self.floor = np.zeros(items, dtype=np.int64)  # the k-th best score, 0 while there are fewer
        self.rows = [np.zeros(0, dtype=np.int64) for _ in range(3)] + [np.zeros(0, dtype=bool)]

    def take(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """``scores``: items x documents."""
        least = self.floor
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, at = np.nonzero(scores >= np.maximum(least, 1)[:, None])
        item, score, key, none = (np.concatenate([a, b]) for a, b in zip(self.rows, (item, scores[item, at], ids[at], missing[at])))
        order = np.lexsort((key, none, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.floor)))
        place = np.arange(len(order)) - first[item[order]]
        order = order[place < self.k]
        self.rows = [x[order] for x in (item, score, key, none)]
        last = place[place < self.k] == self.k - 1
        self.floor[self.rows[0][last]] = self.rows[1][last]


def _scored(batches: Iterator[pa.RecordBatch], shared, k: int) -> Iterator[pa.RecordBatch]:
    plan, weight, documents, length = shared.value
    best = _Best(k, len(plan.items))
    width = max(1, _CELLS // max(1, plan.nodes, len(plan.items)))
    for batch in batches:
        for start in range(0, batch.num_rows, width):
            part = batch.slice(start, width)
            size = part.num_rows
            n = part.column(1).to_numpy()
            ends = part.column(2).value_lengths().to_numpy()
            doc = np.repeat(np.arange(size), ends)
            term = part.column(2).flatten().to_numpy()
            tf = part.column(3).flatten().to_numpy().astype(np.int64)
            m = 10 + 90 * n * documents // length
            value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            held = np.zeros((plan.nodes, size), dtype=np.int64)
            np.add.at(held, (plan.atom[term], doc), value)
            for level in plan.sums:
                held[level[:, 0]] = held[level[:, 1]] + held[level[:, 2]]
            scores = np.stack([held[nodes].sum(axis=0) for nodes in plan.items])
            ids = part.column(0)
            best.take(scores, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
    item, score, key, none = best.rows
    if len(item):
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(key, mask=none), pa.array(score)], names=["item", "id", "score"]
        )


def _weights(found: DataFrame, terms: int) -> tuple[np.ndarray, int, int]:
    """Weight of each term, number of documents with a term, and their length."""
    total = found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = total["documents"], total["length"] or 0
    holding = np.zeros(terms, dtype=np.int64)
    for row in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        holding[row["t"]] = row["df"]
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding]
    return np.array(weight, dtype=np.int64), documents, length


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    postings: int = POSTINGS,
) -> DataFrame:
    """``item, rank, id, score``: the ``k`` documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    shared_folder(spark)
    listed = items.select(F.col(item_key).alias("item"), F.explode(normalised(F.col(item_text).cast("string"))).alias("term")).distinct()
    listed = listed.checkpoint()
    blocks = max(1, math.ceil(listed.count() / postings))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    kind = listed.schema["item"].dataType
    out = None
    for b in range(blocks):
        pairs = listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        part = _search_block(rows, [(r["item"], r["term"]) for r in pairs], kind, k)
        out = part if out is None else out.union(part)
    return out


def _search_block(rows: DataFrame, pairs: Iterable[tuple], kind, k: int) -> DataFrame:
    spark = rows.sparkSession
    terms = sorted({term for _, term in pairs})
    number = {term: i for i, term in enumerate(terms)}
    members = defaultdict(list)
    for item, term in pairs:
        members[item].append(number[term])
    plan = sharing_plan(list(members.values()), len(terms))
    names = spark.createDataFrame(
        [(i, item) for i, item in enumerate(members)], StructType([StructField("number", IntegerType()), StructField("item", kind)])
    )
    vocabulary = spark.sparkContext.broadcast(terms)
    path = scratch_folder(spark, "search-matched")
    rows.mapInArrow(lambda batches: _matched(batches, vocabulary), "id bigint, n bigint, terms array<int>, counts array<int>").write.parquet(path)
    found = spark.read.parquet(path)
    shared = spark.sparkContext.broadcast((plan, *_weights(found, len(terms))))
    hit = found.where("size(terms) > 0")
    best = hit.mapInArrow(lambda batches: _scored(batches, shared, k), "item int, id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names.withColumnsRenamed({"item": "name"}), F.col("item") == F.col("number")).select(F.col("name").alias("item"), "rank", "id", "score")

"""Near-duplicate groups by SimHash, found with vantage-point trees.

1. Each text gets a 64-bit fingerprint: a bit is set when it is set in more than half of the XXH64 hashes of its word shingles.
2. Documents of equal fingerprint are one *class*, one row from here on, so a group of exact copies of any size is one row.
3. A vantage-point tree is fitted on a sample of classes (``SAMPLES`` for each cell it is to have, ``MAX_CELLS`` cells at
   most; fewer than one class in a hundred) and sent to the tasks. Every class is dealt to the cell it lies in and to those whose boundary it is near,
   so that each pair in reach shares a cell (``vantage_tree``). The sample decides the balance of the cells, never the pairs found.
4. A task searches its cell by a tree of its own and returns a spanning forest of the links, at most one edge for each point in it.
   A cell of more than ``block`` classes is dealt in blocks, one task for each pair of blocks.
5. Union-find over the edges gives the components.

The search is exact: no candidate is dropped and no cell is cut.

Defined results: NULL and empty texts and texts without words have fingerprint zero, which is linked like any other. The
component of a row is the smallest id in it, NULL only if all its ids are NULL. Repeated rows are rows of the same class; rows that share
an id but not a text are different documents. A long text is hashed in parts of ``_PART`` shingles, all of them. An empty table gives an empty table.
Ids are integers (anything else is cast to BIGINT). Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import bytetext, vantage_tree
from corpusmill.llm.components import components
from corpusmill.session import scratch_folder, shared_folder

REACH = 3
SEED = 42
CELL = 16_384
SAMPLES = 128
MAX_CELLS = 1024
BLOCK = 200_000
SHARE = 1000
_PART = 1 << 16
_LOWER = bytes(bytetext.LOWER)


def fingerprint(raw: bytes, shingle_words: int = 3) -> int:
    """SimHash of a text as UTF-8; words are runs without ASCII white space, A to Z in lower case."""
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle_words, len(words))
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    total = len(words) - size + 1
    set_bits = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _PART):
        stop = min(at + _PART, total)
        hashes = [digest(joined[a:b], SEED) for a, b in zip(start[at:stop].tolist(), end[at + size - 1 : stop + size - 1].tolist())]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > total, bitorder="little").tobytes(), "little")


def _prints(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column(1).cast(pa.large_binary())
        found = np.fromiter((fingerprint(x.as_py() or b"", shingle_words) for x in raw), dtype=np.uint64, count=len(raw))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "print"])


def _dealt(batches: Iterator[pa.RecordBatch], shared, reach: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False)
        cells, at = vantage_tree.route(shared.value, points.view(np.uint64), reach)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(points[at])], names=["cell", "print"])


def _searched(reach: int):
    def search(table: pa.Table) -> pa.Table:
        points = np.unique(table.column("print").to_numpy())
        root = vantage_tree.forest(points.view(np.uint64), reach)
        linked = np.flatnonzero(root != np.arange(len(points)))
        return pa.table({"a": points[linked], "b": points[root[linked]]})

    return search


def links(classes: DataFrame, reach: int = REACH, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` between values of ``print`` at most ``reach`` bits apart, enough to connect all that are connected."""
    spark = classes.sparkSession
    n = classes.count()
    cells = min(MAX_CELLS, n // cell)
    tree = vantage_tree.Tree()
    if cells > 1:
        rows = classes.orderBy(F.xxhash64("print"), "print").limit(SAMPLES * cells).collect()
        tree = vantage_tree.build(np.array([r["print"] for r in rows], dtype=np.int64).view(np.uint64), SAMPLES, reach)
    else:
        tree.outside[tree.add()] = 0
    shared = spark.sparkContext.broadcast(tree)
    dealt = classes.select("print").mapInArrow(lambda batches: _dealt(batches, shared, reach), "cell int, print bigint").checkpoint()
    # One row per cell, so at most a few times MAX_CELLS.
    sizes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select("cell", F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("int").alias("parts"))
    slots = dealt.join(F.broadcast(parts), "cell").withColumn("slot", F.pmod(F.xxhash64("print"), F.col("parts")).cast("int"))
    # Blocks i < j meet in task (i, j); a cell of one block is task (0, 0).
    other = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != F.col("slot")))
    tasks = slots.select("cell", "print", "slot", F.explode(other).alias("other"))
    tasks = tasks.select("cell", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "print")
    return tasks.groupBy("cell", "i", "j").applyInArrow(_searched(reach), "a bigint, b bigint")


def similar_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = 3,
    reach: int = REACH,
    cell: int = CELL,
    block: int = BLOCK,
) -> DataFrame:
    """``id, print, component_id``, one row for each row of ``docs``; ``print`` is the fingerprint as a signed number."""
    spark = docs.sparkSession
    shared_folder(spark)
    path = scratch_folder(spark, "simhash-prints")
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    texts.mapInArrow(lambda batches: _prints(batches, shingle_words), "id bigint, print bigint").write.parquet(path)
    prints = spark.read.parquet(path)
    classes = prints.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).checkpoint()

    merged = components(links(classes, reach, cell, block))
    groups = classes.join(merged, F.col("print") == F.col("node"))
    best = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = groups.select("print", "component").join(best, "component").select("print", "component_id")
    # Classes without a link are their own component.
    own = classes.join(named.select(F.col("print").alias("_print"), "component_id"), F.col("print") == F.col("_print"), "left")
    result = own.select("print", "n", F.when(F.col("_print").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")).checkpoint()
    # Classes that hold a share of 1 / SHARE of all rows or more, so at most SHARE of them, are sent to the rows instead of dealt with them.
    total = result.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    large = F.broadcast(result.where(F.col("n") * SHARE >= total).select("print", "component_id"))
    rest = prints.join(large.select("print"), "print", "left_anti").join(result, "print")
    return prints.join(large, "print").select("id", "print", "component_id").union(rest.select("id", "print", "component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` whose id is that of their component, columns unchanged; equal rows all stay or go together."""
    names = similar_groups(docs, key, text, **options).where("id <=> component_id").select(F.col("id").alias("_id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("bigint").alias("id"))
    return rows.join(names, F.col("id").eqNullSafe(F.col("_id")), "left_semi").select("row.*")

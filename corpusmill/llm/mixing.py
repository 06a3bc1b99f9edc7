"""Mixing sources to target weights by systematic sampling.

A document's expected number of copies is its source's target over its source's size. The expected copies are
summed along the source's documents in order of size, one random offset per source is added, and a document is
emitted once for each integer its interval crosses. Neighbours in the order are alike in size, so the words taken
differ from the target by less than the size of the longest document.

The expected copies are the same for all documents of a source, so the prefix sum is the rank times that
number. The rank comes from counts: per (source, size), then per (source, size, bucket of the id), and only
inside such a bucket rows are numbered by a window. A source, or one size of a source, that holds a third
of all rows is therefore spread over ``BUCKETS`` groups.

Defined results: NULL and empty texts have size 0 and take no words; a source without words has rate 1. A NULL
source is a source, last in order. Repeated rows are rows of their own. Rows of equal id are ordered by a hash of the
text; equal rows can change places without effect. Reruns give the same copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.native import WORD

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
LIMIT = 3
HEX_DIGITS = 2
BUCKETS = 16**HEX_DIGITS


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``source, source_size, target, rate`` from ``source, source_size`` (one row per source).

    Sharing by weight and resharing what exceeds ``limit`` times a source's size ends where each source has
    ``min(limit * size, weight * level)`` for one common level. Ordered by ``limit * size / weight``, the sources at
    their limit come first; the level of each possible cut is a running sum, and the first cut that no later source
    falls below is the end.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    whole = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        sizes.withColumn("weight", pick)
        .withColumn("cap", limit * F.col("source_size").cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source", "level"))).over(whole)["level"])
    )
    target = F.least("cap", F.col("weight") * F.coalesce("level", F.lit(0.0)))
    rate = F.when(F.col("source_size") == 0, 1.0).otherwise(F.col("target") / F.col("source_size"))
    return cut.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "target", "rate")


def _offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) from the source's name."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("\x00"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def with_copies(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    seed: str = "mix",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id, source, size, source_size, target, copies`` and the columns of ``carry`` (as struct ``row``)."""
    rows = docs.select(
        F.col(key).alias("id"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, HEX_DIGITS).alias("bucket"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
        *([F.xxhash64(text).alias("tie")] if carry else []),
    )
    by_bucket = rows.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    by_size = by_bucket.groupBy("source", "size").agg(F.sum("n").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes_before = by_size.select("source", "size", earlier(Window.partitionBy("source").orderBy("size")).alias("smaller"))
    buckets_before = by_bucket.select("source", "size", "bucket", earlier(Window.partitionBy("source", "size").orderBy("bucket")).alias("sooner"))
    planned = targets(by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, limit)

    inside = Window.partitionBy("source", "size", "bucket").orderBy("id", *(["tie"] if carry else []))
    joined = _matched(rows.withColumn("inside", F.row_number().over(inside)), buckets_before, ("source", "size", "bucket"))
    joined = _matched(_matched(joined, sizes_before, ("source", "size")), planned, ("source",))
    rank = F.col("smaller") + F.col("sooner") + F.col("inside")
    u = _offset(F.col("source"), seed)
    crossed = F.floor(F.col("rate") * rank + u) - F.floor(F.col("rate") * (rank - 1) + u)
    copies = F.least(crossed, F.ceil("rate")).cast("bigint")
    return joined.withColumn("copies", copies).drop("bucket", "inside", "smaller", "sooner", "rate", "tie")


def _matched(rows: DataFrame, counts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join where NULL matches NULL; ``counts`` has one row for each combination of ``on``."""
    counts = counts.select(*[F.col(n).alias(f"_{n}") if n in on else F.col(n) for n in counts.columns])
    condition = F.lit(True)
    for n in on:
        condition = condition & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return rows.join(counts, condition).drop(*[f"_{n}" for n in on])


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", copy: str = "copy", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` once per copy, with its columns and the number of the ``copy`` from 0.

    A column of ``docs`` with the name ``copy`` is replaced.
    """
    names = [c for c in docs.columns if c != copy]
    counted = with_copies(docs, key, source, text, carry=names, **options).where(F.col("copies") > 0)
    return counted.select("row", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)).alias("_n")).select("row.*", F.col("_n").alias(copy))

"""Resampling of documents towards a target distribution by importance weights.

Features are runs of one to ``longest`` words, hashed into buckets. A bucket's gain is the scaled logarithm of its share in
the target over its share in the documents, both with one added to each bucket; a document's weight is the mean of the gains of its
features, looked up in one array of all buckets. Adding Gumbel noise keyed by the id and taking the highest scores draws without
replacement in proportion to the weights.

The draw needs no sort of all rows: scores are written once, and the cutoff is found by bisection, each job counting exactly how many rows lie above some
thresholds, first over the score, then over the ids of the rows that tie with it. Only rows that are drawn are range-partitioned, to be ranked.

Sent to the tasks: one number for each bucket. Collected: the counts of buckets and thresholds, and one row for each partition.

Defined results: NULL and empty texts have no feature and weight 0. A NULL id is scored as an empty text id and comes last
among ties; rows that tie in score and id go by number of features. Repeated rows are rows of their own. Empty tables give an empty result or equal gains. Ids are integers
(anything else is cast to BIGINT). Texts are read whole, however long. Further columns of the inputs are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.plainwords import texts, words_of
from corpusmill.session import scratch_folder, shared_folder

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
_HALVINGS = 4  # steps of the bisection that one job counts
_BLOCK_WORDS = 1 << 19


def _features(column: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, and number of words, number of features, and buckets of all features, for some rows at a time."""
    first, row, lists, held = 0, 0, [], 0
    for row, raw in enumerate(texts(column)):
        lists.append(words_of(raw))
        held += len(lists[-1])
        if held > _BLOCK_WORDS:
            yield (first, *_hashed(lists, longest, buckets))
            first, lists, held = row + 1, [], 0
    if lists:
        yield (first, *_hashed(lists, longest, buckets))


def _hashed(lists: list[list[bytes]], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n_words = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    runs = lists
    if longest > 1:
        runs = [[b" ".join(w[i : i + size]) for size in range(1, longest + 1) for i in range(len(w) - size + 1)] for w in lists]
    n = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
    codes = np.fromiter(map(crc32, chain.from_iterable(runs)), dtype=np.int64, count=int(n.sum()))
    return n_words, n, codes % buckets


def _counted(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for _, _, _, found in _features(batch.column(0), longest, buckets):
            total += np.bincount(found, minlength=buckets)
    here = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(total[here])], names=["bucket", "n"])


def bucket_counts(rows: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features in each bucket, over all rows; each task sends at most one row for each bucket."""
    found = rows.select(F.col(text).cast("string")).mapInArrow(lambda batches: _counted(batches, longest, buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, dtype=np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(source.tolist(), target.tolist())],
        dtype=np.int64,
    )


def _weighted(batches: Iterator[pa.RecordBatch], shared, longest: int) -> Iterator[pa.RecordBatch]:
    gain = shared.value
    for batch in batches:
        for first, n_words, n, found in _features(batch.column(1), longest, len(gain)):
            sums = np.append(0, np.cumsum(gain[found]))
            ends = np.cumsum(n)
            weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[first : first + len(n)], pa.array(n_words), pa.array(n), pa.array(weight)],
                names=["id", "n_words", "n_features", "weight"],
            )


def gumbel(key: Column, seed: int) -> Column:
    """Scaled Gumbel noise of an id, as an integer."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296))).cast("bigint")


def _bisect(rows: DataFrame, column: str, wanted: int, above: bool) -> int:
    """The value that the ``wanted``-th row has, from the top (``above``) or from the bottom, by counting.

    ``rows`` has at least ``wanted`` rows whose ``column`` is not NULL.
    """
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high = ends["low"], ends["high"]
    value = F.col(column)
    while low < high:
        steps = min(high - low, (1 << _HALVINGS) - 1)
        # From the top: cuts c with low < c <= high, and the largest c with at least ``wanted`` rows >= c. From the bottom: the mirror.
        cuts = sorted({low + (high - low) * i // (steps + 1) for i in range(1, steps + 1)} | ({high} if above else {low}))
        cuts = [c for c in cuts if c > low] if above else [c for c in cuts if c < high]
        counts = rows.agg(*[F.count_if(value >= c if above else value <= c).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        enough = [c for i, c in enumerate(cuts) if counts[i] >= wanted]
        if above:
            low, high = max([low, *enough]), min([c - 1 for i, c in enumerate(cuts) if counts[i] < wanted] + [high])
        else:
            low, high = max([c + 1 for i, c in enumerate(cuts) if counts[i] < wanted] + [low]), min([high, *enough])
    return low


def _numbered(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds the position in the partition."""
    at = 0
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(at + 1, at + 1 + batch.num_rows))], schema=kind)
        at += batch.num_rows


_KIND = pa.schema([(x, pa.int64()) for x in ("id", "n_features", "weight", "score", "part", "place")])


def resampled(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` of all ``docs``; ``rank`` is NULL for rows that are not drawn."""
    spark = docs.sparkSession
    shared_folder(spark)
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    shared = spark.sparkContext.broadcast(gain)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    path = scratch_folder(spark, "importance-scores")
    weighed = rows.mapInArrow(lambda batches: _weighted(batches, shared, longest), "id bigint, n_words bigint, n_features bigint, weight bigint")
    weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).write.parquet(path)
    scored = spark.read.parquet(path)

    fit = scored.where(F.col("n_words") >= least_words)
    wanted = percent * fit.count() // 100
    columns = ["id", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    score = _bisect(fit.select("score"), "score", wanted, above=True)
    tied = fit.where(F.col("score") == score).select("id")
    counts = fit.agg(F.count_if(F.col("score") > score).alias("above"), F.count_if((F.col("score") == score) & F.col("id").isNotNull()).alias("named")).first()
    left = wanted - counts["above"]
    last = _bisect(tied.where("id is not null"), "id", left, above=False) if left <= counts["named"] else None
    within = F.col("id") <= last if last is not None else F.lit(True)
    drawn = (F.col("n_words") >= least_words) & ((F.col("score") > score) | ((F.col("score") == score) & within))
    drawn = F.coalesce(drawn, F.lit(False))

    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features")]
    chosen = scored.where(drawn).select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = chosen.withColumn("part", F.spark_partition_id().cast("bigint")).mapInArrow(
        lambda batches: _numbered(batches, _KIND), ", ".join(f"{f.name} bigint" for f in _KIND)
    ).checkpoint()
    before, offsets = 0, []
    for row in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # one row per partition
        offsets.append((row["part"], before))
        before += row["n"]
    starts = spark.createDataFrame(offsets, "part bigint, before bigint")
    rank = F.col("before") + F.col("place")
    ranked = placed.join(F.broadcast(starts), "part").select(*columns, F.when(rank <= wanted, rank).alias("rank"))
    return ranked.union(scored.where(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank")))

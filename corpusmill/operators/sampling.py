"""Seeded sampling, shuffling, draws and label dropout.

Every draw is a function of a row's key, so results do not depend on partitioning or on retries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import randomness as rnd
from corpusmill.operators import ordered
from corpusmill.operators.sizing import broadcast_if_small
from corpusmill.session import shared_folder

# The audit seed and size, the share of dropped labels and the "no label" class.
AUDIT_SEED = 1337
AUDIT_SIZE = 100
P_UNCOND = 0.1
NULL_CLASS = 10
# Largest sample taken by a top-n sort in one task; larger ones are cut from a distributed order.
TOP_N_LIMIT = 100_000


def _cols(key: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in key]


def shuffled(df: DataFrame, key: Sequence[str], seed: int, name: str = "position") -> DataFrame:
    """All rows with their position in a seeded random order. ``key`` must be unique."""
    mixed = df.withColumn("_mix", rnd.order_key(seed, *_cols(key)))
    return ordered.with_ordinal(mixed, ["_mix", *key], name=name).drop("_mix")


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = AUDIT_SEED) -> DataFrame:
    """``n`` distinct rows (all when there are fewer)."""
    if n <= TOP_N_LIMIT:
        return (
            df.withColumn("_mix", rnd.order_key(seed, *_cols(key)))
            .orderBy("_mix", *key)
            .limit(n)
            .drop("_mix")
        )
    return shuffled(df, key, seed, "_at").filter(F.col("_at") < n).drop("_at")


def draw_slots(
    steps: DataFrame,
    shard_sizes: DataFrame,
    batch: int,
    timesteps: int,
    seed: int,
    method: str = "md5",
) -> DataFrame:
    """``step, slot, position, shard..., index, t``: ``batch`` rows with replacement per step.

    ``steps`` has ``step``; ``shard_sizes`` has ``position`` (0..N-1) and ``rows``. Step i reads shard
    i mod N, so shards are visited equally often and a sample of a short shard is drawn more often.
    """
    return _with_draws(assign_shard(steps, shard_sizes), batch, timesteps, seed, method)


def assign_shard(steps: DataFrame, shard_sizes: DataFrame) -> DataFrame:
    """Step i gets the shard at position i mod N.

    With few shards the positions are hot keys, but then the shard table is small and broadcast; with
    many, the steps spread evenly.
    """
    n = shard_sizes.agg(F.count("*")).scalar()
    placed = steps.withColumn("position", F.pmod(F.col("step"), n).cast("bigint"))
    return placed.join(broadcast_if_small(shard_sizes), "position")


def _with_draws(
    placed: DataFrame, batch: int, timesteps: int, seed: int, method: str
) -> DataFrame:
    step, slot = F.col("step"), F.col("slot")
    return (
        placed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(batch - 1))))
        .withColumn("index", rnd.uniform_int(F.col("rows"), seed, F.lit("index"), step, slot, method=method))
        .withColumn("t", rnd.uniform_int(timesteps, seed, F.lit("t"), step, slot, method=method))
    )


# Parts of a whole that a weight is rounded to, so that sums are exact in any order.
WEIGHT_UNITS = 1_000_000


def _upto(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Replace the ticket, the last column, by the position of its shard and the ticket within the shard."""
    ends = shared.value
    for batch in batches:
        ticket = batch.column(batch.num_columns - 1).to_numpy()
        shard = np.searchsorted(ends, ticket, side="right")
        rest = ticket - np.where(shard > 0, ends[np.maximum(shard - 1, 0)], 0)
        names = [*batch.schema.names[:-1], "position", "_rest"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shard), pa.array(rest)], names=names)


def _within(draws: pa.Table, samples: pa.Table) -> pa.Table:
    """The sample of each draw of one shard."""
    samples = samples.sort_by("index")
    ends = np.cumsum(samples.column("units").to_numpy())
    at = pa.array(np.searchsorted(ends, draws.column("_rest").to_numpy(), side="right"))
    return draws.drop_columns(["_rest", "position"]).append_column("index", samples.column("index").take(at))


def draw_slots_weighted(
    steps: DataFrame, samples: DataFrame, batch: int, timesteps: int, seed: int, weight: str = "weight", method: str = "xxhash"
) -> DataFrame:
    """``step, slot, t, dataset, shard, index``: samples drawn with replacement in proportion to their weight, whatever shard they are in.

    ``samples`` has ``dataset, shard, index`` and the weight, 0 or NULL for never. Weights are rounded to units of 1 / ``WEIGHT_UNITS``, so that all
    sums are whole numbers and a draw depends on (seed, step, slot) and the samples alone, on no partitioning. A draw is a ticket: prefix sums over
    shards (one number per shard is sent to the tasks) lead it to a shard, those within the shard to a sample. Only the draws are moved, to
    the narrow rows of their shard.
    """
    spark = steps.sparkSession
    shared_folder(spark)
    units = F.round(F.col(weight).cast("double") * WEIGHT_UNITS).cast("bigint")
    kept = samples.select("dataset", "shard", "index", units.alias("units")).filter("units > 0").checkpoint()
    totals = kept.groupBy("dataset", "shard").agg(F.sum("units").alias("total"))
    shards = ordered.running_sum(totals, "total", ["dataset", "shard"], name="upto").checkpoint()
    ends = np.array([r["upto"] for r in shards.select("upto").orderBy("upto").collect()], dtype=np.int64)
    if not len(ends):
        raise ValueError("no sample has a weight")
    order = Window.orderBy("upto")  # one row per shard
    numbered = shards.select("dataset", "shard", (F.row_number().over(order) - 1).cast("bigint").alias("position"))
    step, slot = F.col("step"), F.col("slot")
    tickets = (
        steps.select("step", F.explode(F.sequence(F.lit(0), F.lit(batch - 1))).alias("slot"))
        .withColumn("t", rnd.uniform_int(timesteps, seed, F.lit("t"), step, slot, method=method))
        .withColumn("ticket", rnd.uniform_int(int(ends[-1]), seed, F.lit("weight"), step, slot, method=method))
    )
    shared = spark.sparkContext.broadcast(ends)
    fields = [f for f in tickets.schema.fields if f.name != "ticket"]
    schema = T.StructType([*fields, T.StructField("position", T.LongType()), T.StructField("_rest", T.LongType())])
    placed = tickets.mapInArrow(lambda batches: _upto(batches, shared), schema).join(broadcast_if_small(numbered), "position")
    on = ["dataset", "shard"]
    placed = placed.select("step", "slot", "t", *on, "position", "_rest")
    out = T.StructType([*[f for f in placed.schema.fields if f.name not in ("position", "_rest")], kept.schema["index"]])
    return placed.groupBy(*on).cogroup(kept.groupBy(*on)).applyInArrow(lambda a, b: _within(a, b), out)


def draw_slots_by_sample(
    steps: DataFrame, total_rows: int, batch: int, timesteps: int, seed: int, method: str = "md5"
) -> DataFrame:
    """The other weighting: every sample of the whole set is equally likely (``ordinal`` drawn)."""
    step, slot = F.col("step"), F.col("slot")
    return (
        steps.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(batch - 1))))
        .withColumn("ordinal", rnd.uniform_int(total_rows, seed, F.lit("index"), step, slot, method=method))
        .withColumn("t", rnd.uniform_int(timesteps, seed, F.lit("t"), step, slot, method=method))
    )


def gather_samples(draws: DataFrame, shards: DataFrame, on: Sequence[str] = ("dataset", "shard", "index")) -> DataFrame:
    """Payload of the drawn rows, with repetition.

    The draws are narrow: while they are few they are broadcast and the payload is read once, without
    a shuffle. Beyond that both sides are shuffled by key, and AQE splits a sample drawn very often.
    """
    return shards.join(broadcast_if_small(draws), list(on))


def drop_labels(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    p: float = P_UNCOND,
    null_class: int = NULL_CLASS,
    seed: int = 0,
    name: str = "y_in",
    method: str = "md5",
) -> DataFrame:
    """With probability ``p`` the label becomes the null class; a missing label is the null class."""
    dropped = rnd.uniform(seed, F.lit("label"), *_cols(key), method=method) < F.lit(p)
    kept = F.coalesce(F.col(label), F.lit(null_class))
    return df.withColumn(name, F.when(dropped, F.lit(null_class)).otherwise(kept).cast("int"))


def batch_of(ordinal: Column, size: int) -> Column:
    return F.floor(ordinal / size).cast("bigint")


def complete_batches(numbered: DataFrame, size: int, ordinal: str = "ordinal", by: Sequence[str] = ()) -> DataFrame:
    """Drop the short last batch of each group."""
    if by:
        counts = numbered.groupBy(*by).agg(F.count("*").alias("_rows"))
        joined = numbered.join(broadcast_if_small(counts), list(by))
        whole = F.floor(F.col("_rows") / size) * size
        return joined.filter(F.col(ordinal) < whole).drop("_rows")
    rows = numbered.agg(F.count("*")).scalar()
    return numbered.filter(F.col(ordinal) < F.floor(rows / size) * size)


def epoch_batches(
    df: DataFrame,
    key: Sequence[str],
    size: int,
    epochs: int,
    seed: int = 0,
    drop_last: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Every row once per epoch, in a new seeded order each time: ``epoch, ordinal, batch``."""
    repeated = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    mixed = repeated.withColumn("_mix", rnd.order_key(seed, F.col("epoch"), *_cols(key)))
    numbered = ordered.with_ordinal(mixed, ["_mix", *key], by=["epoch"], partitions=partitions).drop("_mix")
    kept = numbered
    if drop_last:
        # Every epoch has the same rows, so one count serves all.
        rows = df.agg(F.count("*")).scalar()
        kept = numbered.filter(F.col("ordinal") < F.floor(rows / size) * size)
    return kept.withColumn("batch", batch_of(F.col("ordinal"), size))


def every_n(df: DataFrame, step: str, n: int) -> DataFrame:
    """Rows where ``step`` is a multiple of ``n``; 0 turns the action off."""
    if n == 0:
        return df.filter(F.lit(False))
    return df.filter(F.col(step) % n == 0)

"""Training rows from shards, and the error of predictions on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths
from corpusmill.functions import schedule as sched
from corpusmill.functions import vectors as vec
from corpusmill.operators import models, noising, sampling
from corpusmill.sources import shards as store

# Steps of a session, rows per step, timesteps.
STEPS = 5000
BATCH = 32
TIMESTEPS = 1000


def shard_sizes(shards: DataFrame, seed: int, max_shards: int = 0) -> DataFrame:
    """``position, dataset, shard, rows``: shards in seeded random order, cut to ``max_shards``."""
    sizes = shards.groupBy("dataset", "shard").agg(F.count("*").alias("rows"))
    named = sizes.withColumn("path", F.concat_ws("/", "dataset", paths.shard_name(F.col("shard"))))
    order = sampling.shuffled(named, ["path"], seed).drop("path")
    return order.filter(F.col("position") < max_shards) if max_shards > 0 else order


def session_steps(spark: SparkSession, start: int = 0, steps: int = STEPS) -> DataFrame:
    """The steps of one session; it goes on from the restored step."""
    return spark.range(start, start + steps).withColumnRenamed("id", "step")


def training_draws(
    shards: DataFrame, steps: DataFrame, batch: int = BATCH, timesteps: int = TIMESTEPS, seed: int = 0,
    max_shards: int = 0, method: str = "philox",
) -> DataFrame:
    """``step, slot, dataset, shard, index, t``."""
    sizes = shard_sizes(shards, seed, max_shards)
    draws = sampling.draw_slots(steps, sizes, batch, timesteps, seed, method)
    return draws.select("step", "slot", "dataset", "shard", "index", "t")


def training_table(
    shards: DataFrame,
    steps: DataFrame,
    schedule: DataFrame,
    batch: int = BATCH,
    timesteps: int = TIMESTEPS,
    seed: int = 0,
    max_shards: int = 0,
    method: str = "philox",
    x: str = "x",
) -> DataFrame:
    """Rows of a training session up to the noised input: the draws with ``x, eps, xt``.

    ``shards`` is ``dataset, shard, index, <x>, ...``. ``method`` is how random numbers are made (see
    ``functions.randomness``).
    """
    draws = training_draws(shards, steps, batch, timesteps, seed, max_shards, method)
    return training_rows(shards, draws, schedule, seed, method, x)


def training_rows(
    shards: DataFrame, draws: DataFrame, schedule: DataFrame, seed: int = 0, method: str = "philox", x: str = "x"
) -> DataFrame:
    """The rows of given draws. Of the payload only drawn rows are moved, once, so that the rows of a
    step lie together and all tasks make the noise alike (steps are of equal size). The number of
    partitions is given: making noise costs far more than its bytes tell, so they must not be merged."""
    spread = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sampling.gather_samples(draws, shards).repartition(spread, "step")
    return noising.noised(rows, schedule, ["step", "slot"], seed, x, method)


def stored_training_rows(root: str, draws: DataFrame, schedule: DataFrame, seed: int = 0, method: str = "philox") -> DataFrame:
    """The rows of given draws from a shard store, with ``latent, eps, xt``. The draws are moved to the shards in equal parts, so the payload is
    read once, where the noise is made, and never shuffled."""
    rows = store.gather_stored(draws, root)
    return noising.noised(rows, schedule, ["step", "slot"], seed, "latent", method)


def denoise_eval(
    rows: DataFrame, model: Callable[[], models.Model], size: int, inputs: Sequence[str] = ("xt", "t", "y"),
    bucket: int = 100, batch_size: int = 32,
) -> DataFrame:
    """Score training rows and report per timestep bucket: rows, noise error and error of the x0 estimate.

    Each row is reduced to two error sums before the shuffle.
    """
    scored = models.score_noise(rows, model, tuple(inputs), size, batch_size)
    estimate = vec.predict_x0(F.col("xt"), F.col("pred"), F.col("sqrt_ab"), F.col("sqrt_one_minus_ab"))
    reduced = scored.withColumn("x0_hat", estimate).select(
        F.floor(F.col("t") / bucket).cast("bigint").alias("t_bucket"),
        vec.sum_squares(vec.differences(F.col("pred"), F.col("eps"))).alias("_e"),
        vec.sum_squares(vec.differences(F.col("x0_hat"), F.col("x"))).alias("_x"),
        F.size("eps").alias("_n"),
    )
    return reduced.groupBy("t_bucket").agg(
        F.count("*").alias("rows"),
        (F.sum("_e") / F.sum("_n")).alias("mse"),
        (F.sum("_x") / F.sum("_n")).alias("x0_mse"),
    )


def default_schedule(spark: SparkSession, timesteps: int = TIMESTEPS) -> DataFrame:
    return sched.noise_schedule(spark, timesteps)

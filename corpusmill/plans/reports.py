"""Reports on a training log and on a pair of checkpoints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import ordered, runs, weights
from corpusmill.session import shared_folder
from corpusmill.sources import files as src

# Fixed value: weight of the past in the smoothed loss.
EMA_ALPHA = 0.98


@dataclass
class LogReport:
    """``smoothed`` (step, loss, shard, ema), ``summary`` (describe per column), ``coverage`` (shards)."""

    smoothed: DataFrame
    summary: DataFrame
    coverage: DataFrame


def log_report(log: DataFrame, alpha: float = EMA_ALPHA, topk: int = runs.TOP_SHARDS) -> LogReport:
    """``log`` is ``step, loss, shard``. Rows of equal step stay in the order they were read.

    The parsed log is stored first: sorting reads its input twice, and the lines are parsed once.
    """
    shared_folder(log.sparkSession)
    log = log.select("step", "loss", "shard", F.monotonically_increasing_id().alias("_read")).checkpoint()
    smoothed = ordered.ema(log, "loss", ["step", "_read"], alpha=alpha).drop("_read")
    return LogReport(
        smoothed,
        runs.describe_exact(smoothed, ["step", "loss", "ema"]),
        runs.shard_coverage(log, topk=topk),
    )


@dataclass
class CheckpointReport:
    """``sides`` (param, side), ``norms`` (per layer), ``totals`` (one row), ``top`` (largest changes)."""

    sides: DataFrame
    norms: DataFrame
    totals: DataFrame
    top: DataFrame


def checkpoint_report(a: DataFrame, b: DataFrame, k: int = weights.TOP_LAYERS) -> CheckpointReport:
    norms = weights.layer_norms(a, b)
    return CheckpointReport(
        weights.key_sides(a, b), norms, weights.diff_totals(norms), weights.rank_layers(norms, k)
    )


def oldest_and_newest(params: DataFrame) -> tuple[str, str] | None:
    """First and last checkpoint by name, None when there are fewer than two."""
    names = params.select(F.col("ckpt").alias("name")).filter(F.col("name").rlike(src.CHECKPOINT_NAME))
    first, last = names.agg(F.min("name"), F.max("name")).head()
    return None if first is None or first == last else (first, last)


def compare_checkpoints(params: DataFrame, a: str = "", b: str = "") -> CheckpointReport | None:
    """Compare two named checkpoints of a parameter table, or its oldest with its newest."""
    pair = (a, b) if a and b else oldest_and_newest(params)
    if pair is None:
        return None
    left, right = (params.filter(F.col("ckpt") == name) for name in pair)
    return checkpoint_report(left, right)

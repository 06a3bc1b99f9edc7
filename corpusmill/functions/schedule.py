"""Noise schedule, timestep ladder and timestep features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The linear noise range and the longest period of the timestep features.
BETA_START = 1e-4
BETA_END = 0.02
MAX_PERIOD = 10000.0
MAX_STEPS = 100_000


def noise_schedule(
    spark: SparkSession, steps: int = 1000, beta_start: float = BETA_START, beta_end: float = BETA_END
) -> DataFrame:
    """One row per timestep. ``steps`` is a model parameter, so this table is small by nature; the
    limit makes it safe to broadcast."""
    if not 1 <= steps <= MAX_STEPS:
        raise ValueError(f"steps must be within 1..{MAX_STEPS}")
    gap = (beta_end - beta_start) / max(steps - 1, 1)
    one = F.lit(1.0)
    so_far = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        spark.range(0, steps, 1, 1)
        .select(F.col("id").alias("t"), (F.lit(beta_start) + F.col("id") * F.lit(gap)).alias("beta"))
        .withColumn("alpha", one - F.col("beta"))
        .withColumn("alpha_bar", F.product("alpha").over(so_far))
        .withColumn("sqrt_ab", F.sqrt("alpha_bar"))
        .withColumn("sqrt_one_minus_ab", F.sqrt(one - F.col("alpha_bar")))
    )


def ladder(total: int, steps: Column) -> Column:
    """``(i, t, t_prev)`` pairs of ``steps`` timesteps from ``total - 1`` down to 0, truncated.

    The last timestep is not stepped from, so ``steps = 1`` has no pair.
    """
    last = F.lit(total - 1).cast("bigint")
    gaps = steps.cast("bigint") - 1

    def at(i: Column) -> Column:
        return F.floor(last * (gaps - i) / gaps).cast("bigint")

    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), gaps - 1),
        lambda i: F.struct(i.alias("i"), at(i).alias("t"), at(i + 1).alias("t_prev")),
    )
    empty = F.array().cast("array<struct<i:bigint,t:bigint,t_prev:bigint>>")
    return F.when(gaps >= 1, pairs).otherwise(empty)


def time_features(t: Column, dim: int, style: str = "sin_first") -> Column:
    """Sinusoidal features of a timestep.

    ``sin_first``: sines then cosines, the lowest frequency is ``1/period`` (needs dim >= 4).
    ``cos_first``: cosines then sines, padded with 0 when ``dim`` is odd.
    """
    half = dim // 2
    if style == "sin_first":
        if half < 2:
            raise ValueError("sin_first needs dim >= 4")
        rate, first, second, pad = -math.log(MAX_PERIOD) / (half - 1), F.sin, F.cos, 0
    elif style == "cos_first":
        if half < 1:
            raise ValueError("cos_first needs dim >= 2")
        rate, first, second, pad = -math.log(MAX_PERIOD) / half, F.cos, F.sin, dim % 2
    else:
        raise ValueError(f"unknown style {style!r}")
    steps = F.sequence(F.lit(0), F.lit(half - 1))
    when = t.cast("double")

    def wave(fn):
        return F.transform(steps, lambda i: fn(when * F.exp(i * F.lit(rate))))

    parts = [wave(first), wave(second)]
    if pad:
        parts.append(F.array(F.lit(0.0)))
    return F.concat(*parts)

"""Schedule lookups, forward noising, guidance and prediction error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import randomness as rnd
from corpusmill.functions import vectors as vec
from corpusmill.operators.sampling import NULL_CLASS


def gather_schedule(rows: DataFrame, schedule: DataFrame, t: str = "t", prefix: str = "") -> DataFrame:
    """Add the schedule's columns at each row's timestep. A schedule is limited in size when made."""
    renamed = schedule.select(
        F.col("t").alias("_t"), *[F.col(c).alias(prefix + c) for c in schedule.columns if c != "t"]
    )
    return rows.join(F.broadcast(renamed), F.col(t) == F.col("_t")).drop("_t")


def with_noise(
    rows: DataFrame,
    x0: str,
    key: Sequence[str],
    seed: int,
    name: str = "eps",
    method: str = "philox",
) -> DataFrame:
    """Standard normal noise of the same length as ``x0``."""
    noise = rnd.gaussian_array(F.size(x0), seed, *[F.col(c) for c in key], method=method)
    return rows.withColumn(name, noise)


def noised(
    rows: DataFrame,
    schedule: DataFrame,
    key: Sequence[str],
    seed: int,
    x0: str = "x",
    method: str = "philox",
) -> DataFrame:
    """Forward noising: adds ``eps``, the schedule's columns and ``xt``."""
    with_eps = with_noise(gather_schedule(rows, schedule), x0, key, seed, "eps", method)
    return with_eps.withColumn(
        "xt", vec.q_sample(F.col(x0), F.col("eps"), F.col("sqrt_ab"), F.col("sqrt_one_minus_ab"))
    )


def guidance_inputs(rows: DataFrame, label: str, null_class: int = NULL_CLASS) -> DataFrame:
    """Both inputs of a guided prediction, told apart by ``branch``, for one scoring pass."""
    uncond = rows.withColumn(label, F.lit(null_class)).withColumn("branch", F.lit("uncond"))
    cond = rows.withColumn(label, F.coalesce(F.col(label), F.lit(null_class))).withColumn("branch", F.lit("cond"))
    return uncond.unionByName(cond)


def combine_predictions(
    uncond: DataFrame, cond: DataFrame, scale: Column | float, key: Sequence[str], pred: str = "pred"
) -> DataFrame:
    """Join the two predictions of a sample and combine them."""
    left = uncond.select(*key, F.col(pred).alias("_u"))
    right = cond.select(*key, F.col(pred).alias("_c"))
    return left.join(right, list(key)).select(
        *key, vec.guided(F.col("_u"), F.col("_c"), scale).alias(pred)
    )


def combine_branches(scored: DataFrame, scale: Column | float, key: Sequence[str], pred: str = "pred") -> DataFrame:
    """The same for a scored :func:`guidance_inputs` table: one aggregate instead of a join."""
    both = scored.groupBy(*key).agg(
        F.any_value(F.when(F.col("branch") == "uncond", F.col(pred)), True).alias("_u"),
        F.any_value(F.when(F.col("branch") == "cond", F.col(pred)), True).alias("_c"),
    )
    return both.select(*key, vec.guided(F.col("_u"), F.col("_c"), scale).alias(pred))


def mse(rows: DataFrame, pred: str, target: str, by: Sequence[str | Column] = ()) -> DataFrame:
    """Mean squared error over all elements (not the mean of row means): ``rows, mse``.

    Each row is reduced to two numbers before the shuffle.
    """
    error = vec.sum_squares(vec.differences(F.col(pred), F.col(target)))
    reduced = rows.select(*by, error.alias("_sse"), F.size(target).alias("_n"))
    keys = reduced.columns[:-2]
    return (
        reduced.groupBy(*keys)
        .agg(F.count("*").alias("rows"), (F.sum("_sse") / F.sum("_n")).alias("mse"))
    )

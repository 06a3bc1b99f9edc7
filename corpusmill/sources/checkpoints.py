"""Checkpoint parameters as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARAM_COLUMNS = ["param", "shape", "values"]


def normalise_params(df: DataFrame) -> DataFrame:
    """``[ckpt, step,] param, shape, values`` from any of three layouts.

    One row per parameter (or per block of one) is taken as it is. One row per checkpoint has a map
    ``model``, or, for a raw state, a map ``state``, from name to ``struct<shape, values>``.
    """
    rest = [c for c in ("ckpt", "step") if c in df.columns]
    if all(c in df.columns for c in PARAM_COLUMNS):
        block = [c for c in ("block",) if c in df.columns]
        return df.select(*rest, "param", *block, "shape", F.col("values").cast("array<double>").alias("values"))
    nested = [F.col(c) for c in ("model", "state") if c in df.columns]
    if not nested:
        raise ValueError("no parameters found: expected param rows, or a column 'model' or 'state'")
    entries = df.select(*rest, F.explode(F.coalesce(*nested)).alias("param", "_v"))
    return entries.select(
        *rest, "param", F.col("_v.shape").alias("shape"), F.col("_v.values").cast("array<double>").alias("values")
    )


def read_checkpoint_params(spark: SparkSession, path: str) -> DataFrame:
    return normalise_params(spark.read.parquet(path))


def in_blocks(params: DataFrame, size: int) -> DataFrame:
    """The long form: each parameter's values cut into blocks of ``size``."""
    rest = [c for c in params.columns if c != "values"]
    starts = F.sequence(F.lit(0), F.greatest(F.size("values") - 1, F.lit(0)), F.lit(size))
    return params.select(*rest, "values", F.posexplode(starts).alias("block", "_from")).select(
        *rest, "block", F.slice("values", F.col("_from") + 1, size).alias("values")
    )

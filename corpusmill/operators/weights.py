"""Checkpoint comparison.

A parameter is one row ``param, shape, values``, or several rows ``param, shape, block, values`` when
a tensor is too large for one row. Every function takes both forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import vectors as vec

# Fixed value: the number of layers ranked.
TOP_LAYERS = 10


def _keys(df: DataFrame) -> list[str]:
    return ["param", "block"] if "block" in df.columns else ["param"]


def key_sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """``param, side``: both, only_a or only_b."""
    left = a.select("param").distinct().withColumn("_a", F.lit(True))
    right = b.select("param").distinct().withColumn("_b", F.lit(True))
    side = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "only_a").otherwise("only_b")
    return left.join(right, "param", "full_outer").select("param", side.alias("side"))


def common_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("param").intersect(b.select("param"))


def keys_only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("param").subtract(b.select("param"))


def layer_norms(a: DataFrame, b: DataFrame) -> DataFrame:
    """``param, l2, linf, n`` of the difference, for parameters of equal shape in both.

    Each block is reduced to three numbers next to the join, so a tensor of any size is summed from
    partial results.
    """
    keys = _keys(a)
    left = a.select(*keys, F.col("shape").alias("_sa"), F.col("values").alias("_va"))
    right = b.select(*keys, F.col("shape").alias("_sb"), F.col("values").alias("_vb"))
    delta = vec.differences(F.col("_va"), F.col("_vb"))
    reduced = (
        left.join(right, keys)
        .filter(F.col("_sa") == F.col("_sb"))
        .select("param", delta.alias("_d"))
        .select(
            "param",
            vec.sum_squares(F.col("_d")).alias("_ss"),
            vec.max_abs(F.col("_d")).alias("_max"),
            F.size("_d").cast("bigint").alias("_n"),
        )
    )
    return reduced.groupBy("param").agg(
        F.sqrt(F.sum("_ss")).alias("l2"), F.max("_max").alias("linf"), F.sum("_n").alias("n")
    )


def diff_totals(norms: DataFrame) -> DataFrame:
    """Layers and parameters compared, sum of the layers' L2 norms, global maximum."""
    return norms.agg(
        F.count("*").alias("layers"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("params"),
        F.coalesce(F.sum("l2"), F.lit(0.0)).alias("sum_l2"),
        F.coalesce(F.max("linf"), F.lit(0.0)).alias("max_linf"),
    )


def rank_layers(norms: DataFrame, k: int = TOP_LAYERS) -> DataFrame:
    return norms.orderBy(F.desc("l2"), "param").limit(k)

"""Images with their sidecar captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import paths
from corpusmill.functions.text import clean_caption


def pair_by_stem(
    images: DataFrame, sidecars: DataFrame, caption: Column, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Inner join of ``images.path`` and ``sidecars.path`` on the path without extension.

    An image without a sidecar drops out; an empty caption stays. Stems are unique on the sidecar
    side and hold a handful of images at most, so the keys cannot be skewed.
    """
    left = images.select("path", *keep, paths.stem(F.col("path")).alias("_stem"))
    right = sidecars.select(paths.stem(F.col("path")).alias("_stem"), clean_caption(caption).alias("caption"))
    return left.join(right, "_stem").drop("_stem")


def pair_count(pairs: DataFrame, archive: str) -> DataFrame:
    return pairs.groupBy(archive).agg(F.count("*").alias("n"))

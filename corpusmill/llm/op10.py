"""Query of the near-duplicate groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.near_duplicates import near_duplicates
from corpusmill.llm.registry import query, table


@query("op10_minhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle_words=4, threshold=0.8)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

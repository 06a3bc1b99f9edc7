"""Query of the SimHash groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.registry import query, table
from corpusmill.llm.simhash_groups import similar_groups


@query("op11_simhash_near_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

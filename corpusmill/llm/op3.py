"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import quality_model
from corpusmill.llm.registry import query, table

CUT = 0.3


def _held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op3_quality_gam")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~_held_out("doc_id"))
    model = quality_model.train(docs, labels)
    found = quality_model.scored(docs, model)
    return found.select(F.col("id").alias("doc_id"), _held_out("id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

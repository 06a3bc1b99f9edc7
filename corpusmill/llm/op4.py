"""Query of the secret scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import secrets, spans
from corpusmill.llm.registry import query, table


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.with_spans(docs, secrets.train(docs))
    base = F.col("base_spans")
    return found.select(
        "row.doc_id", *[spans.count(base, k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(spans.printed(base), 256).alias("base_sha256"), spans.printed(F.col("spans")).alias("spans"),
    )

"""The corpus pipeline: documents to a training mix, in five stages.

Each stage takes the documents that the one before it kept and returns documents of the same columns; the last adds the number of
the copy. NULL and empty texts go in the first stage (no words).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontamination, mixing, near_duplicates, personal_data, quality_rules
from corpusmill.llm.registry import table
from corpusmill.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return near_duplicates.one_of_each(docs, shingle_words=5, threshold=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return personal_data.redacted(docs, personal_data.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per copy in the mix of sources."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", redact),
    ("mixing", mix),
]

# The near-duplicate and redaction stages have no practical SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Query of the main texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.main_text import extracted
from corpusmill.llm.registry import query, table


@query("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).select("page.page_id", "page.url", "text", "n_chars")

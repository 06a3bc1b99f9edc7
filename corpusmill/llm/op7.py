"""Query of the WARC round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.registry import query, table
from corpusmill.llm.warc import read_archives, write_archives
from corpusmill.session import scratch_folder

SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
s as (select page_id, octet_length(b)::bigint as payload_bytes, sha1(b) as h from p),
m as (select *, max(page_id) over (partition by h) as top from s)
select page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 4 * 5 + 1)::int, 5))::bigint >> (5 * (3 - i % 4))::int) & 31) + 1)::int, 1)), '') as payload_digest,
  case when page_id is not distinct from top then 'response' else 'revisit' end as record_type,
  case when page_id is not distinct from top then null else top end as refers_to
from m
"""


@query("op7_warc", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = read_archives(spark, path)
    return found.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")

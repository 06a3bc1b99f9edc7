"""Query of the mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import mixing
from corpusmill.llm.registry import query, table

SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, ''))[1:2] as bucket, hash(text) as h
  from documents
), s as (
  select source, sum(size)::double as source_size,
         [5.0, 2.0, 1.0][((row_number() over (order by source asc nulls last) - 1) % 3 + 1)::int] as weight
  from d group by source
), r as (select *, 3 * source_size as cap, 3 * source_size / weight as ratio from s),
l as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over p, 0)) / (sum(weight) over () - coalesce(sum(weight) over p, 0)) as level
  from r window p as (order by ratio, source nulls last rows between unbounded preceding and 1 preceding)
), f as (select level from l where ratio >= level order by ratio, source limit 1),
t as (
  select source, source_size, least(cap, weight * coalesce((select level from f), 0)) as target from l
), t2 as (
  select *, case when source_size = 0 then 1.0 else target / source_size end as rate,
    ('0x' || md5('mix' || coalesce(source, chr(0)))[1:8])::bigint / 4294967296.0::double as u
  from t
), k as (
  select *, row_number() over (partition by source order by size, bucket, doc_id) as rank from d
)
select k.doc_id, k.size, t2.source_size::bigint as source_size, t2.target,
  (k.size * least(floor(rate * rank + u) - floor(rate * (rank - 1) + u), ceil(rate)))::bigint as taken
from k join t2 on k.source is not distinct from t2.source
"""


@query("op5_mixing", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

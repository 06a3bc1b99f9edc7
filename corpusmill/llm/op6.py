"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.decontamination import hits
from corpusmill.llm.registry import query, table

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = rf"""
with b as (select item_id::varchar as item, {_WORDS} as w from benchmark),
g as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as gram
  from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)
), d as (select doc_id, {_WORDS} as w from documents),
p as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d cross join (select distinct n from g) where len(w) >= n)
), h as (select p.doc_id, p.i, p.n, g.item from p join g using (gram, n)),
c as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from h) group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from h) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join t using (doc_id)
"""


@query("op6_decontamination", SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )

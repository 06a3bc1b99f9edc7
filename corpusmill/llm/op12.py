"""Query of the ranked search of all benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.ranked_search import search
from corpusmill.llm.registry import query, table

_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SQL = rf"""
with d as (select doc_id, {_TERMS} as w from documents),
total as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w)) as n_terms from d),
tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from d) group by all),
i as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
w as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf, total where term in (select term from i) group by term
), p as (
  select i.item_id, tf.doc_id,
    sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + ((90 * len(d.w)::bigint * n_docs) // n_terms::bigint)))))::bigint as score
  from i join tf using (term) join w using (term) join d using (doc_id) cross join total
  group by all
)
select item_id, r::int as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as r from p where score > 0
) where r <= 10
"""


@query("op12_ranked_search", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.withColumnsRenamed({"item": "item_id", "id": "doc_id"})

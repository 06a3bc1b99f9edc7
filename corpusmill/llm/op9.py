"""Query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import quality_rules as q
from corpusmill.llm.registry import query, table

_STOPS = ", ".join(f"'{w}'" for w in q.STOP_WORDS)
_ENDS = q.PUNCTUATION.replace("'", "''")

SQL = rf"""
with base as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents
), win as (
  select doc_id, unnest(range(1, len(w) - 3)) as i, w from base where len(w) >= 5
), keyed as (
  select doc_id, i, array_to_string(w[i:i+4], ' ') as k from win
), twice as (
  select doc_id, i, count(*) over (partition by doc_id, k) as n from keyed
), covered as (
  select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 5)) as j from twice where n > 1) group by doc_id
), counted as (
  select doc_id, len(w)::bigint as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words,
    len(list_filter(w, lambda x: lower(trim(x, '{_ENDS}')) in ({_STOPS})))::bigint as n_stop,
    (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::bigint as n_capitals,
    (length(t) - length(replace(t, '!', '')))::bigint as n_excl,
    len(string_split(t, chr(10)))::bigint as n_lines
  from base left join covered c using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
    and word_chars / n_words >= 2.0 and word_chars / n_words <= 15.0
    and n_symbols / n_words <= 0.20 and n_excl / n_words <= 0.50 and n_capitals / word_chars <= 0.50
    and (n_words < 100 or n_stop / n_words >= 0.01) and n_dup_lines / n_lines <= 0.50 as kept
from counted
"""


@query("op9_quality_rules", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = q.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.size(F.array_intersect("failed_rules", F.array(*[F.lit(x) for x in q.BASE_RULES]))) > 0
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col("quality")[c].alias(c) for c in counts], base.alias("base_failed"), "kept")

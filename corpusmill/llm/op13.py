"""Query of the importance resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.importance import resampled
from corpusmill.llm.registry import query, table

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# crc32 of each distinct word: its table of 256 numbers from the polynomial, then the bytes one after the other.
SQL = rf"""
with d as (select doc_id, {_WORDS} as w from documents),
dw as (select doc_id, term, count(*) as n from (select doc_id, unnest(w) as term from d) group by all),
bw as (select term, count(*) as n from (select unnest({_WORDS}) as term from benchmark) group by all),
step as (
  select list(v order by i) as steps from (
    select i, list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) as r(i)
  )
), code as (
  select term, xor(4294967295, list_reduce(
    list_concat([4294967295::bigint], list_transform(range(1, 2 * octet_length(encode(term)), 2), lambda i: ('0x' || substr(hex(encode(term)), i, 2))::bigint)),
    lambda c, b: xor(steps[1 + (xor(c, b) & 255)], c >> 8))) % 10000 as bucket
  from (select term from dw union select term from bw) cross join step
), s as (select bucket, sum(n)::bigint as s_n from dw join code using (term) group by bucket),
t as (select bucket, sum(n)::bigint as t_n from bw join code using (term) group by bucket),
total as (select (select coalesce(sum(s_n), 0) from s)::bigint as s_all, (select coalesce(sum(t_n), 0) from t)::bigint as t_all),
gain as (
  select bucket, floor(1000 * ln(((coalesce(t_n, 0) + 1) * (s_all + 10000))::double / ((s_n + 1) * (t_all + 10000))::double))::bigint as gain
  from s left join t using (bucket) cross join total
), sums as (select doc_id, sum(gain * n)::bigint as g from dw join code using (term) join gain using (bucket) group by doc_id),
weighed as (
  select doc_id, len(w)::bigint as n_features, case when len(w) = 0 then 0 else floor(coalesce(g, 0)::double / len(w)) end::bigint as weight,
    ('0x' || sha256('2024:' || doc_id)[1:8])::bigint as h
  from d left join sums using (doc_id)
), scored as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from weighed),
drawn as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scored where n_features >= 20
)
select doc_id, n_features, weight, score, (case when r <= n * 10 // 100 then r end)::bigint as rank from scored left join drawn using (doc_id)
"""


@query("op13_importance_resampling", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
    return found.withColumnRenamed("id", "doc_id")

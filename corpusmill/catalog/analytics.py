"""Training logs, checkpoints and file retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query, r6, sql_r6
from corpusmill.functions import text as tx
from corpusmill.functions import vectors as vec
from corpusmill.operators import ordered, runs, sampling, weights
from corpusmill.plans import reports
from corpusmill.sources import checkpoints as ck
from corpusmill.sources import files as src
from corpusmill.sources import text as text_src


def _log(spark, sf_dir):
    return text_src.parse_train_log(b.log_lines(spark, sf_dir))


@query("log_parse", b.sql("log", "SELECT step, loss, shard, form FROM log"))
def log_parse(spark, sf_dir):
    return text_src.sorted_by_step(_log(spark, sf_dir))


@query(
    "log_counts",
    b.sql("log_lines", """SELECT CASE WHEN event_id % 17 = 0 THEN 'unmatched' WHEN event_id % 2 = 0 THEN 'shard' ELSE 'seconds' END AS kind,
    count(*) AS n FROM log_lines GROUP BY 1"""),
)
def log_counts(spark, sf_dir):
    return text_src.train_log_counts(b.log_lines(spark, sf_dir))


@query("log_every_n", b.sql("log", "SELECT step, loss FROM log WHERE step % 10 = 0"))
def log_every_n(spark, sf_dir):
    return sampling.every_n(_log(spark, sf_dir), "step", 10).select("step", "loss")


@query(
    "log_format",
    """SELECT event_id, printf('step %07d | loss %.6f | %.1fs', event_id, value, (event_id % 50) / 10.0::DOUBLE) AS line FROM events""",
)
def log_format(spark, sf_dir):
    line = tx.trainer_line(F.col("event_id"), F.col("value"), (F.col("event_id") % 50) / 10.0)
    return b.table(spark, sf_dir, "events").select("event_id", line.alias("line"))


def _describe_sql(views: str, column: str, source: str) -> str:
    stats = f"""count({column}) AS count, {sql_r6(f'avg({column})')} AS mean, {sql_r6(f'stddev_samp({column})')} AS std,
        {sql_r6(f'min({column})')} AS min, {sql_r6(f'quantile_cont({column}::DOUBLE, 0.25)')} AS q25,
        {sql_r6(f'quantile_cont({column}::DOUBLE, 0.5)')} AS q50, {sql_r6(f'quantile_cont({column}::DOUBLE, 0.75)')} AS q75,
        {sql_r6(f'max({column})')} AS max"""
    return f"SELECT '{column}' AS \"column\", {stats} FROM {source}"


def _rounded(described):
    return described.select(
        "column", "count", *[r6(F.col(c)).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    )


@query(
    "loss_describe",
    b.sql("log", _describe_sql("log", "step", "log") + " UNION ALL " + _describe_sql("log", "loss", "log")),
)
def loss_describe(spark, sf_dir):
    return _rounded(runs.describe_exact(_log(spark, sf_dir).select("step", "loss"), ["step", "loss"]))


@query(
    "loss_ema",
    b.sql("", f"SELECT event_id, {sql_r6('ema')} AS ema FROM folded", recursive=b.FOLDED),
)
def loss_ema(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return ordered.ema(rows, "value", ["event_id"], ["event_type"]).select("event_id", r6(F.col("ema")).alias("ema"))


@query(
    "log_report",
    b.sql("log", " UNION ALL ".join(
        [_describe_sql("log", "step", "log"), _describe_sql("log", "loss", "log"), _describe_sql("log", "ema", "folded")]
    ), recursive="""
    numbered AS (SELECT loss, row_number() OVER (ORDER BY step) AS rn FROM log),
    folded AS (SELECT rn, loss AS ema FROM numbered WHERE rn = 1
        UNION ALL SELECT n.rn, 0.98::DOUBLE * f.ema + (1 - 0.98::DOUBLE) * n.loss FROM folded f JOIN numbered n ON n.rn = f.rn + 1)"""),
)
def log_report(spark, sf_dir):
    return _rounded(reports.log_report(_log(spark, sf_dir)).summary)


@query(
    "shard_coverage",
    f"""SELECT user_id AS shard, n, {sql_r6('100::DOUBLE * n / (SELECT count(*) FROM events)')} AS percent,
    greatest((SELECT count(DISTINCT user_id) FROM events) - 20, 0) AS hidden FROM
    (SELECT user_id, count(*) AS n, min(event_id) AS first FROM events GROUP BY user_id ORDER BY n DESC, first LIMIT 20)""",
)
def shard_coverage(spark, sf_dir):
    top = runs.shard_coverage(b.table(spark, sf_dir, "events"), "user_id", 20, "event_id")
    return top.withColumn("percent", r6(F.col("percent")))


@query(
    "coverage_totals",
    """SELECT count(*) AS lines, count(*) FILTER (event_id % 5 <> 0) AS total, count(*) FILTER (event_id % 5 = 0) AS unsharded,
    count(DISTINCT user_id) FILTER (event_id % 5 <> 0) AS shards, greatest(count(DISTINCT user_id) FILTER (event_id % 5 <> 0) - 20, 0) AS hidden FROM events""",
)
def coverage_totals(spark, sf_dir):
    return runs.coverage_totals(b.table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("shard")))


@query(
    "value_quantiles",
    f"""SELECT name AS "column", prob, {sql_r6('q')} AS value FROM (
    SELECT 'value' AS name, unnest([0.01, 0.5, 0.99]::DOUBLE[]) AS prob, unnest(quantile_cont(value::DOUBLE, [0.01, 0.5, 0.99])) AS q FROM events
    UNION ALL SELECT 'kind', unnest([0.01, 0.5, 0.99]::DOUBLE[]), unnest(quantile_cont((event_id % 3)::DOUBLE, [0.01, 0.5, 0.99])) FROM events)""",
)
def value_quantiles(spark, sf_dir):
    """Ranks far out, and a column in which each value is held by a third of all rows."""
    rows = b.table(spark, sf_dir, "events").select("value", (F.col("event_id") % 3).alias("kind"))
    found = runs.exact_quantiles(rows, ["value", "kind"], (0.01, 0.5, 0.99))
    return found.withColumn("value", r6(F.col("value")))


@query(
    "step_seconds",
    f"""SELECT user_id, event_id, {sql_r6('''(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id))
    / 1000000::DOUBLE''')} AS seconds FROM events""",
)
def step_seconds(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    timed = runs.step_seconds(rows, "ts", ["ts", "event_id"], ["user_id"])
    return timed.select("user_id", "event_id", r6(F.col("seconds")).alias("seconds"))


@query(
    "cache_retention",
    """WITH files AS (SELECT user_id AS name, max(ts) AS ts, arg_max(CAST(round(value * 100) AS BIGINT), ts) AS bytes FROM events GROUP BY user_id)
    SELECT name, bytes, sum(bytes) OVER (ORDER BY ts DESC, name) <= (SELECT sum(bytes) // 2 FROM files) AS kept FROM files""",
)
def cache_retention(spark, sf_dir):
    files = runs.last_access(b.access_log(spark, sf_dir))
    half = F.floor(runs.cache_bytes(files).scalar() / 2)
    return runs.retain_within_budget(files, half).select("name", "bytes", "kept")


@query(
    "ckpt_read",
    b.sql("ckpt_a", f"SELECT param, CAST(len(vals) AS INTEGER) AS n, {sql_r6('list_sum(vals)')} AS total FROM ckpt_a"),
)
def ckpt_read(spark, sf_dir):
    params = ck.normalise_params(b.checkpoint_a(spark, sf_dir))
    return params.select("param", F.size("values").alias("n"), r6(vec.total(F.col("values"))).alias("total"))


@query(
    "ckpt_list",
    """SELECT name, CAST(regexp_extract(name, '_(\\d+)\\.pt$', 1) AS BIGINT) AS step, greatest((SELECT count(*) FROM events) - 10, 0) AS older
    FROM (SELECT 'unet_step_' || event_id * 100 || '.pt' AS name FROM events ORDER BY name DESC LIMIT 10)""",
)
def ckpt_list(spark, sf_dir):
    name = F.concat(F.lit("ckpt/unet_step_"), F.col("event_id") * 100, F.lit(".pt"))
    return src.list_checkpoints(b.table(spark, sf_dir, "events").select(name.alias("name")))


def _pair(spark, sf_dir):
    return b.checkpoint_a(spark, sf_dir), b.checkpoint_b(spark, sf_dir)


@query(
    "ckpt_keys",
    b.sql("ckpt_a ckpt_b", """SELECT CASE WHEN a.param IS NULL THEN 'only_b' WHEN b.param IS NULL THEN 'only_a' ELSE 'both' END AS side,
    count(*) AS n FROM ckpt_a a FULL JOIN ckpt_b b ON a.param = b.param GROUP BY 1"""),
)
def ckpt_keys(spark, sf_dir):
    return weights.key_sides(*_pair(spark, sf_dir)).groupBy("side").agg(F.count("*").alias("n"))


@query("keys_common", b.sql("ckpt_a ckpt_b", "SELECT param FROM ckpt_a INTERSECT SELECT param FROM ckpt_b"))
def keys_common(spark, sf_dir):
    return weights.common_keys(*_pair(spark, sf_dir))


@query("keys_only_a", b.sql("ckpt_a ckpt_b", "SELECT param FROM ckpt_a EXCEPT SELECT param FROM ckpt_b"))
def keys_only_a(spark, sf_dir):
    return weights.keys_only_in(*_pair(spark, sf_dir))


@query("keys_only_b", b.sql("ckpt_a ckpt_b", "SELECT param FROM ckpt_b EXCEPT SELECT param FROM ckpt_a"))
def keys_only_b(spark, sf_dir):
    left, right = _pair(spark, sf_dir)
    return weights.keys_only_in(right, left)


@query(
    "ckpt_diff",
    b.sql("norms", f"SELECT param, {sql_r6('l2')} AS l2, {sql_r6('linf')} AS linf, n FROM norms"),
)
def ckpt_diff(spark, sf_dir):
    norms = weights.layer_norms(*_pair(spark, sf_dir))
    return norms.select("param", r6(F.col("l2")).alias("l2"), r6(F.col("linf")).alias("linf"), "n")


@query(
    "ckpt_diff_totals",
    b.sql("norms", f"""SELECT count(*) AS layers, CAST(coalesce(sum(n), 0) AS BIGINT) AS params, {sql_r6('coalesce(sum(l2), 0)')} AS sum_l2,
    {sql_r6('coalesce(max(linf), 0)')} AS max_linf FROM norms"""),
)
def ckpt_diff_totals(spark, sf_dir):
    totals = weights.diff_totals(weights.layer_norms(*_pair(spark, sf_dir)))
    return totals.select("layers", "params", r6(F.col("sum_l2")).alias("sum_l2"), r6(F.col("max_linf")).alias("max_linf"))


@query(
    "ckpt_top10",
    b.sql("norms", f"SELECT param, {sql_r6('l2')} AS l2, {sql_r6('linf')} AS linf, n FROM norms ORDER BY norms.l2 DESC, param LIMIT 10"),
)
def ckpt_top10(spark, sf_dir):
    top = reports.checkpoint_report(*_pair(spark, sf_dir)).top
    return top.select("param", r6(F.col("l2")).alias("l2"), r6(F.col("linf")).alias("linf"), "n")


@query(
    "shape_check",
    b.sql("ckpt_b", "SELECT CAST(64 AS INTEGER) AS expected, CAST(len(vals) AS INTEGER) AS actual, len(vals) = 64 AS same, count(*) AS n FROM ckpt_b GROUP BY 2, 3"),
)
def shape_check(spark, sf_dir):
    params = b.checkpoint_b(spark, sf_dir)
    return params.groupBy(
        F.lit(64).alias("expected"), F.size("values").alias("actual"), vec.has_shape(F.col("values"), F.array(F.lit(64))).alias("same")
    ).agg(F.count("*").alias("n"))

"""Seeded draws, shuffles and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query, r6, sql_r6
from corpusmill.functions import randomness as rnd
from corpusmill.functions import vectors as vec
from corpusmill.operators import sampling
from corpusmill.plans import training
from corpusmill.session import scratch_folder
from corpusmill.sources import shards as store

_UNIFORM_SEED, _EPOCH_SEED, _LABEL_SEED = 3, 5, 2
_EPOCH_BATCH = 128


@query(
    "uniform_draws",
    f"""SELECT doc_id, slot, {sql_r6(b.sql_uniform(_UNIFORM_SEED, 'doc_id', 'slot'))} AS u FROM
    (SELECT doc_id, CAST(unnest(range(4)) AS INTEGER) AS slot FROM documents)""",
)
def uniform_draws(spark, sf_dir):
    rows = b.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("slot"))
    return rows.withColumn("u", r6(rnd.uniform(_UNIFORM_SEED, F.col("doc_id"), F.col("slot"))))


@query(
    "gaussian_noise",
    b.sql("latents", f"""SELECT sample, count(*) AS n, {sql_r6('avg(z)')} AS mean, {sql_r6('sum(z * z)')} AS sum_sq FROM
    (SELECT sample, {b.sql_gaussian('pos', b.EPS_SEED, 'sample')} AS z FROM
    (SELECT sample, unnest(range(len(x))) AS pos FROM latents)) GROUP BY sample"""),
)
def gaussian_noise(spark, sf_dir):
    z = rnd.gaussian_array(F.size("x"), b.EPS_SEED, F.col("sample"))
    rows = b.latents(spark, sf_dir).select("sample", z.alias("z"))
    return rows.select(
        "sample",
        F.size("z").cast("bigint").alias("n"),
        r6(vec.total(F.col("z")) / F.size("z")).alias("mean"),
        r6(vec.sum_squares(F.col("z"))).alias("sum_sq"),
    )


@query(
    "step_shard",
    b.sql("sizes", "SELECT event_id AS step, dataset, shard FROM events JOIN sizes ON position = event_id % (SELECT count(*) FROM sizes)"),
)
def step_shard(spark, sf_dir):
    sizes = training.shard_sizes(b.shard_keys(spark, sf_dir), b.SHUFFLE_SEED)
    steps = b.table(spark, sf_dir, "events").select(F.col("event_id").alias("step"))
    return sampling.assign_shard(steps, sizes).select("step", "dataset", "shard")


def _draws(spark, sf_dir):
    keys = b.shard_keys(spark, sf_dir)
    return keys, training.training_draws(keys, b.steps(spark, sf_dir), b.BATCH, b.TIMESTEPS, b.SHUFFLE_SEED, method="md5")


@query(
    "training_draws",
    b.sql("draws", "SELECT step, CAST(slot AS INTEGER) AS slot, dataset, shard, index, t FROM draws"),
)
def training_draws(spark, sf_dir):
    return _draws(spark, sf_dir)[1]


@query(
    "gather_samples",
    b.sql("draws", "SELECT step, CAST(slot AS INTEGER) AS slot, sample FROM draws JOIN shards USING (dataset, shard, index)"),
)
def gather_samples(spark, sf_dir):
    keys, draws = _draws(spark, sf_dir)
    return sampling.gather_samples(draws, keys).select("step", "slot", "sample")


@query(
    "training_table",
    b.sql("draws schedule", f"""SELECT step, CAST(slot AS INTEGER) AS slot, t, {sql_r6('sum(xt)')} AS xt_sum, {sql_r6('sum(xt * xt)')} AS xt_sum_sq FROM
    (SELECT step, slot, t, sqrt(alpha_bar) * v + sqrt(1::DOUBLE - alpha_bar) * {b.sql_gaussian('pos', b.SHUFFLE_SEED, 'step', 'slot')} AS xt
    FROM (SELECT step, slot, t, unnest(x) AS v, unnest(range(len(x))) AS pos
        FROM draws JOIN shards USING (dataset, shard, index)) JOIN schedule USING (t))
    GROUP BY step, slot, t"""),
)
def training_table(spark, sf_dir):
    keys, draws = _draws(spark, sf_dir)
    schedule = training.default_schedule(spark, b.TIMESTEPS)
    rows = training.training_rows(b.with_payload(spark, sf_dir, keys), draws, schedule, b.SHUFFLE_SEED, "md5")
    xt = F.col("xt")
    return rows.select("step", "slot", "t", r6(vec.total(xt)).alias("xt_sum"), r6(vec.sum_squares(xt)).alias("xt_sum_sq"))


@query(
    "label_dropout",
    b.sql("latents", f"""SELECT CAST(CASE WHEN {b.sql_uniform(_LABEL_SEED, "'label'", 'sample')} < 0.1::DOUBLE THEN 10 ELSE y END AS INTEGER) AS y_in,
    count(*) AS n FROM latents GROUP BY 1"""),
)
def label_dropout(spark, sf_dir):
    rows = b.latents(spark, sf_dir).select("sample", "y")
    return sampling.drop_labels(rows, "y", ["sample"], seed=_LABEL_SEED).groupBy("y_in").agg(F.count("*").alias("n"))


@query(
    "epoch_batches",
    b.sql("latents", f"""SELECT epoch, (rn - 1) // {_EPOCH_BATCH} AS batch, count(*) AS rows, min(sample) AS first_sample, CAST(sum(sample) AS BIGINT) AS sample_sum FROM
    (SELECT CAST(epoch AS INTEGER) AS epoch, sample, total, row_number() OVER (PARTITION BY epoch ORDER BY {b.sql_digest(_EPOCH_SEED, 'epoch', 'sample')}, sample) AS rn
    FROM (SELECT sample, unnest(range(2)) AS epoch, count(*) OVER () AS total FROM latents))
    WHERE rn <= total // {_EPOCH_BATCH} * {_EPOCH_BATCH} GROUP BY 1, 2"""),
)
def epoch_batches(spark, sf_dir):
    keys = b.latents(spark, sf_dir).select("sample")
    batches = sampling.epoch_batches(keys, ["sample"], _EPOCH_BATCH, 2, _EPOCH_SEED)
    return batches.groupBy("epoch", "batch").agg(
        F.count("*").alias("rows"), F.min("sample").alias("first_sample"), F.sum("sample").alias("sample_sum")
    )


@query(
    "weighted_draws",
    b.sql("shards", f"""SELECT step, CAST(slot AS INTEGER) AS slot, dataset, shard, index, t FROM
    (SELECT step, slot, {b.sql_uniform_int('(SELECT sum(sample % 4 * 500000) FROM shards)', b.SHUFFLE_SEED, "'weight'", 'step', 'slot')} AS ticket,
        {b.sql_uniform_int(str(b.TIMESTEPS), b.SHUFFLE_SEED, "'t'", 'step', 'slot')} AS t
        FROM (SELECT vec_id AS step, unnest(range({b.BATCH})) AS slot FROM embeddings))
    JOIN (SELECT dataset, shard, index, sample % 4 * 500000 AS units, sum(sample % 4 * 500000) OVER (ORDER BY dataset, shard, index) AS upto FROM shards)
    ON ticket >= upto - units AND ticket < upto"""),
)
def weighted_draws(spark, sf_dir):
    samples = b.shard_keys(spark, sf_dir).withColumn("weight", F.col("sample") % 4 / 2)
    return sampling.draw_slots_weighted(b.steps(spark, sf_dir), samples, b.BATCH, b.TIMESTEPS, b.SHUFFLE_SEED, method="md5")


@query(
    "gather_stored",
    b.sql("draws", f"""SELECT step, CAST(slot AS INTEGER) AS slot, sample, {sql_r6('list_sum(list_transform(x, lambda v: v::FLOAT::DOUBLE))')} AS total
    FROM draws JOIN shards USING (dataset, shard, index)"""),
)
def gather_stored(spark, sf_dir):
    """The samples written to a store, and of each draw the payload read from it."""
    root = scratch_folder(spark, "store")
    encoded = b.latents(spark, sf_dir).select(
        F.col("sample").cast("string").alias("path"), F.lit("").alias("caption"), F.col("x").cast("array<float>").alias("latent"), F.array(F.size("x")).alias("shape"),
        F.lit(16).alias("image_size"), F.lit("none").alias("encoder_id"), F.lit(1.0).alias("latent_scale"), "dataset", F.col("sample").alias("ordinal"),
    )
    store.write_shards(encoded, root, ["ordinal"], b.SHARD_ROWS)
    rows = store.gather_stored(_draws(spark, sf_dir)[1].drop("t"), root, ["path", "latent"])
    total = vec.total(F.col("latent").cast("array<double>"))
    return rows.select("step", "slot", F.col("path").cast("bigint").alias("sample"), r6(total).alias("total"))

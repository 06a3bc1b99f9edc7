"""Schedules, noising, guidance, single denoising steps, pixels."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query, r6, sql_r6
from corpusmill.functions import images, schedule
from corpusmill.functions import randomness as rnd
from corpusmill.functions import vectors as vec
from corpusmill.operators import models, noising
from corpusmill.plans import training

_Z_SEED = 13
_SCALES = (0, 1, 3)


def _schedule(spark):
    return training.default_schedule(spark, b.TIMESTEPS)


def _timed(spark, sf_dir):
    return b.with_t(b.latents(spark, sf_dir))


def _noised(spark, sf_dir):
    return noising.noised(_timed(spark, sf_dir), _schedule(spark), ["sample"], b.EPS_SEED, method="md5")


def _exploded(df, *keys):
    """``pos, value`` rows of an array column ``out``."""
    return df.select(*keys, F.posexplode("out").alias("pos", "v")).select(*keys, "pos", r6(F.col("v")).alias("value"))


@query(
    "noise_schedule",
    b.sql("timed schedule", f"""SELECT sample, t, {sql_r6('beta')} AS beta, {sql_r6('alpha')} AS alpha, {sql_r6('alpha_bar')} AS alpha_bar,
    {sql_r6('sqrt(alpha_bar)')} AS sqrt_ab, {sql_r6('sqrt(1::DOUBLE - alpha_bar)')} AS sqrt_one_minus_ab FROM timed JOIN schedule USING (t)"""),
)
def noise_schedule(spark, sf_dir):
    rows = noising.gather_schedule(_timed(spark, sf_dir).select("sample", "t"), _schedule(spark))
    return rows.select(
        "sample", "t", *[r6(F.col(c)).alias(c) for c in ("beta", "alpha", "alpha_bar", "sqrt_ab", "sqrt_one_minus_ab")]
    )


@query(
    "q_sample",
    b.sql("noised", f"""SELECT sample, CAST(pos AS INTEGER) AS pos,
    {sql_r6('sqrt(alpha_bar) * v + sqrt(1::DOUBLE - alpha_bar) * eps')} AS value FROM noised"""),
)
def q_sample(spark, sf_dir):
    return _exploded(_noised(spark, sf_dir).withColumnRenamed("xt", "out"), "sample")


@query("x0_roundtrip", b.sql("latents", "SELECT sample, 0.0::DOUBLE AS max_error FROM latents"))
def x0_roundtrip(spark, sf_dir):
    back = vec.predict_x0(F.col("xt"), F.col("eps"), F.col("sqrt_ab"), F.col("sqrt_one_minus_ab"))
    error = vec.max_abs(vec.differences(back, F.col("x")))
    return _noised(spark, sf_dir).select("sample", r6(error).alias("max_error"))


@query("latent_scale_roundtrip", b.sql("latents", "SELECT sample, 0.0::DOUBLE AS max_error FROM latents"))
def latent_scale_roundtrip(spark, sf_dir):
    back = vec.unscaled(vec.scaled(F.col("x")))
    return b.latents(spark, sf_dir).select("sample", r6(vec.max_abs(vec.differences(back, F.col("x")))).alias("max_error"))


@query(
    "cfg_combine",
    b.sql("elements", f"""SELECT sample, s, {sql_r6('sum(CASE WHEN s > 0 THEN v + s * (0.9::DOUBLE * v - v) ELSE 0.9::DOUBLE * v END)')} AS total
    FROM (SELECT *, CAST(unnest([0, 1, 3]) AS INTEGER) AS s FROM elements) GROUP BY sample, s"""),
)
def cfg_combine(spark, sf_dir):
    scales = F.explode(F.array(*[F.lit(s) for s in _SCALES]))
    uncond = b.latents(spark, sf_dir).select("sample", scales.alias("s"), F.col("x").alias("pred"))
    cond = uncond.withColumn("pred", vec.scaled(F.col("pred"), 0.9))
    both = noising.combine_predictions(uncond, cond, F.col("s").cast("double"), ["sample", "s"])
    return both.select("sample", "s", r6(vec.total(F.col("pred"))).alias("total"))


@query(
    "cfg_inputs",
    b.sql("latents", """SELECT branch, CAST(label AS INTEGER) AS label, count(*) AS rows FROM
    (SELECT 'cond' AS branch, y AS label FROM latents UNION ALL SELECT 'uncond', 10 FROM latents) GROUP BY 1, 2"""),
)
def cfg_inputs(spark, sf_dir):
    rows = b.latents(spark, sf_dir).select("sample", F.col("y").alias("label"))
    return noising.guidance_inputs(rows, "label").groupBy("branch", "label").agg(F.count("*").alias("rows"))


@query(
    "mse_by_t",
    b.sql("noised", f"""SELECT t // 100 AS t_bucket, count(DISTINCT sample) AS rows, {sql_r6('sum((0.9::DOUBLE * eps - eps) ** 2) / count(*)')} AS mse
    FROM noised GROUP BY 1"""),
)
def mse_by_t(spark, sf_dir):
    rows = _noised(spark, sf_dir).withColumn("pred", vec.scaled(F.col("eps"), 0.9))
    bucket = F.floor(F.col("t") / 100).cast("bigint").alias("t_bucket")
    return noising.mse(rows, "pred", "eps", [bucket]).withColumn("mse", r6(F.col("mse")))


def _linear_model():
    def predict(xt, t, y):
        return 0.5 * xt + 0.001 * t[:, None] - 0.01 * y[:, None]

    return predict


_PRED = "(0.5::DOUBLE * xt + 0.001::DOUBLE * t - 0.01::DOUBLE * y)"
_XT = "SELECT *, sqrt(alpha_bar) * v + sqrt(1::DOUBLE - alpha_bar) * eps AS xt FROM noised"


@query(
    "score_noise",
    b.sql("noised", f"SELECT sample, t, y, {sql_r6(f'sum({_PRED})')} AS pred_sum FROM ({_XT}) GROUP BY sample, t, y"),
)
def score_noise(spark, sf_dir):
    rows = _noised(spark, sf_dir).select("sample", "xt", F.col("t").cast("double").alias("t"), F.col("y").cast("double").alias("y"))
    scored = models.score_noise(rows, _linear_model, size=64)
    return scored.select(
        "sample", F.col("t").cast("bigint").alias("t"), F.col("y").cast("int").alias("y"), r6(vec.total(F.col("pred"))).alias("pred_sum")
    )


@query(
    "denoise_eval",
    b.sql("noised", f"""SELECT t // 100 AS t_bucket, count(DISTINCT sample) AS rows, {sql_r6('sum((pred - eps) ** 2) / count(*)')} AS mse,
    {sql_r6('sum(((xt - sqrt(1::DOUBLE - alpha_bar) * pred) / sqrt(alpha_bar) - v) ** 2) / count(*)')} AS x0_mse
    FROM (SELECT *, {_PRED} AS pred FROM ({_XT})) GROUP BY 1"""),
)
def denoise_eval(spark, sf_dir):
    rows = _noised(spark, sf_dir).withColumn("t", F.col("t").cast("double")).withColumn("y", F.col("y").cast("double"))
    report = training.denoise_eval(rows, _linear_model, size=64)
    return report.select("t_bucket", "rows", r6(F.col("mse")).alias("mse"), r6(F.col("x0_mse")).alias("x0_mse"))


@query(
    "posterior_sample",
    b.sql("latents", f"""SELECT sample, CAST(pos AS INTEGER) AS pos,
    {sql_r6(f"(m + exp(greatest(-30::DOUBLE, least(20::DOUBLE, lv)) / 2) * {b.sql_gaussian('pos', _Z_SEED, 'sample')}) * 0.18215::DOUBLE")} AS value
    FROM (SELECT sample, unnest(x[1:32]) AS m, unnest(x[33:64]) * 200::DOUBLE AS lv, unnest(range(32)) AS pos FROM latents)"""),
)
def posterior_sample(spark, sf_dir):
    wide = F.concat(F.slice("x", 1, 32), vec.scaled(F.slice("x", 33, 32), 200.0))
    noise = rnd.gaussian_array(32, _Z_SEED, F.col("sample"))
    return _exploded(b.latents(spark, sf_dir).select("sample", vec.sampled_posterior(wide, noise).alias("out")), "sample")


_EPS = b.sql_gaussian("pos", b.EPS_SEED, "sample")
_Z = b.sql_gaussian("pos", _Z_SEED, "sample")


def _step_rows(spark, sf_dir, prev: bool):
    """Each sample at the fixed timesteps, with noise and schedule."""
    ts = F.explode(F.array(*[F.lit(t) for t in (0, 1, 500, 999)]))
    rows = b.latents(spark, sf_dir)
    rows = noising.with_noise(rows, "x", ["sample"], b.EPS_SEED, "eps", "md5")
    rows = noising.with_noise(rows, "x", ["sample"], _Z_SEED, "z", "md5").withColumn("t", ts)
    rows = noising.gather_schedule(rows, _schedule(spark))
    if prev:
        rows = rows.withColumn("t_prev", F.floor(F.col("t") / 2).cast("int"))
        rows = noising.gather_schedule(rows, _schedule(spark), "t_prev", "prev_")
    return rows


@query(
    "ddpm_step",
    b.sql("elements schedule", f"""SELECT sample, CAST(t AS INTEGER) AS t, {sql_r6('''sum(1::DOUBLE / sqrt(alpha) * (v - beta / sqrt(1::DOUBLE - alpha_bar) * eps)
    + CASE WHEN t = 0 THEN 0 ELSE sqrt(beta) * z END)''')} AS total FROM
    (SELECT sample, v, {_EPS} AS eps, {_Z} AS z FROM elements) CROSS JOIN (SELECT * FROM schedule WHERE t IN (0, 1, 500, 999))
    GROUP BY sample, t"""),
)
def ddpm_step(spark, sf_dir):
    c = F.col
    out = vec.ddpm_step(c("x"), c("eps"), c("z"), c("t"), c("beta"), c("alpha"), c("alpha_bar"))
    return _step_rows(spark, sf_dir, False).select("sample", "t", r6(vec.total(out)).alias("total"))


@query(
    "ddim_step",
    b.sql("elements schedule", f"""SELECT sample, CAST(t AS INTEGER) AS t, eta, {sql_r6('''sum(sqrt(ap) * ((v - sqrt(1::DOUBLE - ab) * eps) / sqrt(ab))
    + sqrt(1::DOUBLE - ap - sigma * sigma) * eps + sigma * z)''')} AS total FROM
    (SELECT sample, v, {_EPS} AS eps, {_Z} AS z FROM elements) CROSS JOIN
    (SELECT c.t, eta, c.alpha_bar AS ab, p.alpha_bar AS ap, CASE WHEN eta > 0 THEN
        eta * sqrt((1::DOUBLE - p.alpha_bar) / (1::DOUBLE - c.alpha_bar)) * sqrt(1::DOUBLE - c.alpha_bar / p.alpha_bar) ELSE 0 END AS sigma
     FROM (SELECT *, unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS eta FROM schedule WHERE t IN (0, 1, 500, 999)) c JOIN schedule p ON p.t = c.t // 2)
    GROUP BY sample, t, eta"""),
)
def ddim_step(spark, sf_dir):
    c = F.col
    rows = _step_rows(spark, sf_dir, True).withColumn("eta", F.explode(F.array(F.lit(0.0), F.lit(1.0))))
    out = vec.ddim_step(c("x"), c("eps"), c("z"), c("alpha_bar"), c("prev_alpha_bar"), c("eta"))
    return rows.select("sample", "t", "eta", r6(vec.total(out)).alias("total"))


@query(
    "ddim_ladder",
    b.sql("latents", """SELECT sample, i, (999 * (gaps - i)) // gaps AS t, (999 * (gaps - i - 1)) // gaps AS t_prev FROM
    (SELECT sample, y * 7 + 1 AS gaps, unnest(range(y * 7 + 1)) AS i FROM latents)"""),
)
def ddim_ladder(spark, sf_dir):
    pairs = schedule.ladder(b.TIMESTEPS, F.col("y") * 7 + 2)
    return b.latents(spark, sf_dir).select("sample", F.explode(pairs).alias("p")).select("sample", "p.i", "p.t", "p.t_prev")


_LN = math.log(schedule.MAX_PERIOD)


def _sql_features(style: str, dim: int) -> str:
    half = dim // 2
    rate = -_LN / (half - 1 if style == "sin_first" else half)
    first, second = ("sin", "cos") if style == "sin_first" else ("cos", "sin")
    width = 2 * half + (dim % 2 if style == "cos_first" else 0)
    wave = f"t * exp((pos % {half}) * ({rate!r}::DOUBLE))"
    return f"""SELECT sample, '{style}' AS style, CAST(pos AS INTEGER) AS pos,
        {sql_r6(f"CASE WHEN pos < {half} THEN {first}({wave}) WHEN pos < {2 * half} THEN {second}({wave}) ELSE 0 END")} AS value
        FROM (SELECT sample, t, unnest(range({width})) AS pos FROM timed)"""


@query(
    "time_features",
    b.sql("timed", _sql_features("sin_first", 8) + " UNION ALL " + _sql_features("cos_first", 9)),
)
def time_features(spark, sf_dir):
    rows = _timed(spark, sf_dir).select("sample", "t")
    both = F.explode(
        F.array(
            F.struct(F.lit("sin_first").alias("style"), schedule.time_features(F.col("t"), 8, "sin_first").alias("out")),
            F.struct(F.lit("cos_first").alias("style"), schedule.time_features(F.col("t"), 9, "cos_first").alias("out")),
        )
    )
    return _exploded(rows.select("sample", both.alias("f")).select("sample", "f.style", "f.out"), "sample", "style")


_BYTE = "CAST(trunc(greatest(0::DOUBLE, least(1::DOUBLE, (v * 8 + 1) / 2)) * 255) AS INTEGER)"


@query(
    "pixel_denormalise",
    b.sql("elements", f"""SELECT sample, CAST(pos AS INTEGER) AS pos, {_BYTE} AS value,
    {sql_r6('greatest(-1::DOUBLE, least(1::DOUBLE, v * 8))')} AS clipped FROM elements"""),
)
def pixel_denormalise(spark, sf_dir):
    wide = vec.scaled(F.col("x"), 8.0)
    rows = b.latents(spark, sf_dir).select("sample", F.posexplode(wide).alias("pos", "v"))
    return rows.select("sample", "pos", images.byte_of(F.col("v")).alias("value"), r6(images.clipped(F.col("v"))).alias("clipped"))


@query(
    "pixel_normalise",
    b.sql("elements", f"""SELECT sample, CAST(pos AS INTEGER) AS pos, byte, {sql_r6('byte::DOUBLE / 255 * 2 - 1')} AS value FROM
    (SELECT sample, pos, {_BYTE} AS byte FROM elements)"""),
)
def pixel_normalise(spark, sf_dir):
    pixels = images.to_bytes(vec.scaled(F.col("x"), 8.0))
    rows = b.latents(spark, sf_dir).select("sample", F.arrays_zip(pixels.alias("byte"), images.to_unit_signed(pixels).alias("value")).alias("z"))
    return rows.select("sample", F.posexplode("z").alias("pos", "p")).select("sample", "pos", "p.byte", r6(F.col("p.value")).alias("value"))


@query(
    "axis_permute",
    b.sql("latents", f"""SELECT sample, CAST(pos AS INTEGER) AS pos, {sql_r6('x[(pos % 16) * 4 + pos // 16 + 1]')} AS value,
    {sql_r6('x[(3 - pos % 4) * 16 + pos // 4 + 1]')} AS back FROM (SELECT sample, x, unnest(range(64)) AS pos FROM latents)"""),
)
def axis_permute(spark, sf_dir):
    first = images.channels_first(F.col("x"), 4, 4, 4)
    last = images.channels_last(F.col("x"), 4, 4, 4, reverse=True)
    rows = b.latents(spark, sf_dir).select("sample", F.arrays_zip(first.alias("value"), last.alias("back")).alias("z"))
    return rows.select("sample", F.posexplode("z").alias("pos", "p")).select(
        "sample", "pos", r6(F.col("p.value")).alias("value"), r6(F.col("p.back")).alias("back")
    )


def _mean_decoder():
    def decode(z):
        return np.repeat(z, 2, axis=1) * 4.0

    return decode


@query(
    "decode_latents",
    b.sql("shards", """SELECT sample, 2 * count(*) AS pixels,
    CAST(2 * sum(trunc(greatest(0::DOUBLE, least(1::DOUBLE, (v * 4 + 1) / 2)) * 255)) AS BIGINT) AS byte_sum
    FROM (SELECT sample, unnest(x) AS v FROM shards WHERE index < 8) GROUP BY sample"""),
)
def decode_latents(spark, sf_dir):
    scaled = b.shards(spark, sf_dir).select("sample", "index", vec.scaled(F.col("x")).alias("latent"), F.lit(vec.LATENT_SCALE).alias("latent_scale"))
    decoded = models.decode_latents(scaled, _mean_decoder, 8, 64, 128)
    return decoded.select(
        "sample",
        F.size("image").cast("bigint").alias("pixels"),
        F.aggregate("image", F.lit(0).cast("bigint"), lambda acc, v: acc + v).alias("byte_sum"),
    )

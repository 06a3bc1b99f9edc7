"""Expressions on numeric arrays; arithmetic is in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The latent scale, the log-variance limits and the size ratio of image and latent.
LATENT_SCALE = 0.18215
LOG_VARIANCE_RANGE = (-30.0, 20.0)
LATENT_CHANNELS = 4
LATENT_STRIDE = 8


def doubles(x: Column) -> Column:
    return x.cast("array<double>")


def scaled(x: Column, factor: Column | float = LATENT_SCALE) -> Column:
    by = F.lit(factor) if isinstance(factor, float) else factor
    return F.transform(x, lambda v: v * by)


def unscaled(x: Column, factor: Column | float = LATENT_SCALE) -> Column:
    by = F.lit(factor) if isinstance(factor, float) else factor
    return F.transform(x, lambda v: v / by)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def q_sample(x0: Column, eps: Column, sqrt_ab: Column, sqrt_one_minus_ab: Column) -> Column:
    """Forward noising: ``sqrt_ab * x0 + sqrt_one_minus_ab * eps``."""
    return F.zip_with(x0, eps, lambda x, e: sqrt_ab * x + sqrt_one_minus_ab * e)


def predict_x0(xt: Column, eps: Column, sqrt_ab: Column, sqrt_one_minus_ab: Column) -> Column:
    """The inverse of :func:`q_sample` for a given noise."""
    return F.zip_with(xt, eps, lambda x, e: (x - sqrt_one_minus_ab * e) / sqrt_ab)


def guided(uncond: Column, cond: Column, scale: Column | float) -> Column:
    """``uncond + scale*(cond - uncond)``; a scale of 0 or less means the conditional one alone."""
    s = F.lit(float(scale)) if isinstance(scale, (int, float)) else scale
    mixed = F.zip_with(uncond, cond, lambda u, c: u + s * (c - u))
    return F.when(s > 0, mixed).otherwise(cond)


def ddpm_step(
    x: Column, eps: Column, noise: Column, t: Column, beta: Column, alpha: Column, alpha_bar: Column
) -> Column:
    """One reverse step: the mean, plus noise unless ``t`` is 0."""
    keep = F.lit(1.0) / F.sqrt(alpha)
    pull = beta / F.sqrt(F.lit(1.0) - alpha_bar)
    mean = F.zip_with(x, eps, lambda v, e: keep * (v - pull * e))
    noisy = F.zip_with(mean, noise, lambda m, z: m + F.sqrt(beta) * z)
    return F.when(t == 0, mean).otherwise(noisy)


def ddim_step(
    x: Column, eps: Column, noise: Column, ab: Column, ab_prev: Column, eta: Column | float = 0.0
) -> Column:
    """One step along the ladder from noise level ``ab`` to ``ab_prev``."""
    e = F.lit(float(eta)) if isinstance(eta, (int, float)) else eta
    one = F.lit(1.0)
    spread = e * F.sqrt((one - ab_prev) / (one - ab)) * F.sqrt(one - ab / ab_prev)
    sigma = F.when(e > 0, spread).otherwise(F.lit(0.0))
    toward = F.sqrt(one - ab_prev - sigma * sigma)
    x0 = predict_x0(x, eps, F.sqrt(ab), F.sqrt(one - ab))
    ahead = F.zip_with(x0, eps, lambda v, n: F.sqrt(ab_prev) * v + toward * n)
    return F.zip_with(ahead, noise, lambda v, z: v + sigma * z)


def sampled_posterior(mean_logvar: Column, noise: Column, scale: float = LATENT_SCALE) -> Column:
    """Halves are mean and log-variance: ``scale * (mean + exp(logvar/2) * noise)``."""
    low, high = LOG_VARIANCE_RANGE
    half = (F.size(mean_logvar) / 2).cast("int")
    mean = F.slice(mean_logvar, 1, half)
    spread = F.transform(
        F.slice(mean_logvar, half + 1, half),
        lambda v: F.exp(F.greatest(F.lit(low), F.least(F.lit(high), v)) / 2),
    )
    noise_part = F.zip_with(spread, noise, lambda s, z: s * z)
    return F.zip_with(mean, noise_part, lambda m, z: (m + z) * F.lit(scale))


def differences(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def sum_squares(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)


def l2_norm(x: Column) -> Column:
    return F.sqrt(sum_squares(x))


def max_abs(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: F.greatest(acc, F.abs(v)))


def latent_size(image_size: int, channels: int = LATENT_CHANNELS) -> int:
    """Number of values of one latent."""
    return channels * (image_size // LATENT_STRIDE) ** 2


def has_shape(x: Column, shape: Column) -> Column:
    """The array is as long as the product of its shape."""
    return F.size(x) == F.aggregate(shape, F.lit(1), lambda acc, v: acc * v)

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import images, paths, rules, schedule
from corpusmill.functions import randomness as rnd
from corpusmill.functions import text as tx
from corpusmill.functions import vectors as vec


def one(spark, column):
    return spark.range(1).select(column.alias("v")).head()["v"]


@pytest.mark.parametrize(
    "path, ext",
    [("a/b.JPG", ".jpg"), ("a/.png", ""), ("a/b", ""), ("a.b/c", ""), ("a/b.tar.gz", ".gz"), ("x.tif", ".tif"), (".x/y.Png", ".png")],
)
def test_extension(spark, path, ext):
    assert one(spark, paths.extension(F.lit(path))) == ext


@pytest.mark.parametrize("path, want", [("a.b.jpg", "a.b.txt"), ("d.e/f", "d.e/f.txt"), ("d/.x", "d/.x.txt"), ("a\n.jpg", "a\n.txt")])
def test_with_extension(spark, path, want):
    assert one(spark, paths.with_extension(F.lit(path), ".txt")) == want


@pytest.mark.parametrize("path, want", [("./a//b/./c", "a/b/c"), ("a/b", "a/b"), ("s3://x//y", "s3://x/y"), ("././a", "a")])
def test_normalised(spark, path, want):
    assert one(spark, paths.normalised(F.lit(path))) == want


def test_numbers(spark):
    assert one(spark, paths.zero_pad(F.lit(42))) == "00042"
    assert one(spark, paths.zero_pad(F.lit(1234567))) == "1234567"
    assert one(spark, paths.zero_fill(F.lit("1234567"))) == "1234567"
    assert one(spark, paths.number_in(F.lit("shard_00042.pt"), paths.SHARD_NUMBER)) == 42
    assert one(spark, paths.shard_number(F.lit("shard_42.pt"))) is None
    assert one(spark, paths.shard_number(F.lit("shard_100000.pt"))) == 100_000


def test_uri_parts(spark):
    assert tuple(one(spark, paths.uri_parts(F.lit("s3://b/k/e y")))) == ("b", "k/e y")
    assert tuple(one(spark, paths.uri_parts(F.lit("s3://b")))) == ("b", "")
    assert one(spark, paths.uri_parts(F.lit("http://b/k"), strict=False)) is None
    with pytest.raises(Exception, match="expected s3://"):
        one(spark, paths.uri_parts(F.lit("http://b/k")))


def test_rebased(spark):
    assert one(spark, paths.stored_path(F.lit("raw/x/a.jpg"), "raw/", "out")) == "out/images/x/a.jpg"
    assert one(spark, paths.stored_path(F.lit("raw/a.jpg"), "raw", "out", store=False)) == "raw/a.jpg"


def test_caption(spark):
    assert one(spark, tx.clean_caption(F.lit(" \t a\tb\nc\r\n　"))) == "a b c"
    assert one(spark, tx.valid_text(F.unhex(F.lit("61FF62")))) == "ab"


@pytest.mark.parametrize(
    "line, want",
    [
        ("step 10 | loss 0.5 | shard s1", (10, 0.5, "s1", "shard")),
        ("x step 0000010 | loss 1e-05 | 1.2s", (10, 1e-5, None, "seconds")),
        ("step 3 | loss 1.2.3 | shard s1", (3, None, "s1", "shard")),
        ("saved step 3", None),
    ],
)
def test_log_line(spark, line, want):
    got = one(spark, tx.parsed_log_line(F.lit(line)))
    assert (tuple(got) if got else None) == want


def test_log_line_keeps_nan(spark):
    assert math.isnan(one(spark, tx.parsed_log_line(F.lit("step 3 | loss nan | shard a"))).loss)


def test_manifest_line(spark):
    line = one(spark, tx.manifest_line(F.lit("s"), F.lit(3), F.lit("p"), F.lit('é"\t')))
    assert line == '{"shard":"s","index":3,"path":"p","caption":"é\\"\\t"}'
    assert one(spark, tx.parsed_manifest_line(F.lit(line)).path) == "p"
    assert one(spark, tx.parsed_manifest_line(F.lit(line[:20])).path) is None


def test_rules(spark):
    w, h = F.lit(10), F.lit(0)
    assert one(spark, rules.aspect_ratio(w, h)) == 0.0
    assert one(spark, rules.within_aspect(F.lit(1), F.lit(2))) is True
    assert one(spark, rules.within_aspect(F.lit(2), F.lit(1))) is True
    assert one(spark, rules.too_small(F.lit(256), F.lit(256))) is False
    assert tuple(one(spark, rules.verdict(F.lit(-1), F.lit(-1)))) == (False, "corrupt_or_unreadable", None, None)


def test_pixels(spark):
    back = one(spark, images.to_bytes(images.to_unit_signed(F.sequence(F.lit(0), F.lit(255)))))
    assert all(abs(a - b) <= 1 for a, b in zip(back, range(256)))
    assert one(spark, images.to_bytes(F.array(F.lit(-3.0), F.lit(3.0)))) == [0, 255]
    assert tuple(one(spark, images.crop_square(F.lit(7), F.lit(4)))) == (4, 1, 0)


def test_axes(spark):
    x = np.arange(24).reshape(2, 4, 3)
    first = one(spark, images.channels_first(F.lit(x.ravel().tolist()), 2, 4, 3))
    assert first == x.transpose(2, 0, 1).ravel().tolist()
    flipped = one(spark, images.channels_first(F.lit(x.ravel().tolist()), 2, 4, 3, reverse=True))
    assert flipped == x[:, :, ::-1].transpose(2, 0, 1).ravel().tolist()
    assert one(spark, images.channels_last(F.lit(first), 2, 4, 3)) == x.ravel().tolist()


@pytest.mark.parametrize("method", rnd.METHODS)
def test_random_numbers_are_random(spark, method):
    rows = spark.range(4000).select(
        rnd.uniform(1, F.col("id"), method=method).alias("u"), rnd.gaussian_array(5, 1, F.col("id"), method=method).alias("z")
    ).collect()
    u, z = np.array([r.u for r in rows]), np.array([r.z for r in rows])
    assert z.shape == (4000, 5) and 0 <= u.min() and u.max() < 1
    assert abs(u.mean() - 0.5) < 0.03 and abs(u.std() - 12**-0.5) < 0.02
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03 and abs(np.corrcoef(z.T) - np.eye(5)).max() < 0.06


@pytest.mark.parametrize("method", rnd.METHODS)
def test_random_numbers_do_not_depend_on_partitions(spark, method):
    def draw(n):
        df = spark.range(50).repartition(n).select("id", rnd.gaussian_array(4, 9, F.col("id"), method=method).alias("z"))
        return sorted((r.id, tuple(r.z)) for r in df.collect())

    assert draw(1) == draw(3) == draw(8)


def test_noise_length(spark):
    assert one(spark, rnd.gaussian_array(0, 1, F.lit(1))) == []
    assert len(one(spark, rnd.gaussian_array(7, 1, F.lit(1)))) == 7


def test_schedule(spark):
    rows = schedule.noise_schedule(spark, 1000).orderBy("t").collect()
    betas = np.linspace(1e-4, 0.02, 1000)
    assert np.allclose([r.beta for r in rows], betas)
    assert np.allclose([r.alpha_bar for r in rows], np.cumprod(1 - betas), rtol=1e-9)
    assert rows[-1].alpha_bar == pytest.approx(4.03582976537e-05, rel=1e-9)
    (single,) = schedule.noise_schedule(spark, 1).collect()
    assert single.beta == 1e-4
    with pytest.raises(ValueError):
        schedule.noise_schedule(spark, 0)


@pytest.mark.parametrize("steps", [1, 2, 30, 50, 1001, 1500])
def test_ladder(spark, steps):
    got = [tuple(p) for p in one(spark, schedule.ladder(1000, F.lit(steps)))]
    ts = [999 * (steps - 1 - i) // (steps - 1) for i in range(steps)] if steps > 1 else [999]
    assert got == list(zip(range(steps - 1), ts, ts[1:]))


@pytest.mark.parametrize("style, dim", [("sin_first", 8), ("cos_first", 8), ("cos_first", 9)])
def test_time_features(spark, style, dim):
    got, half = one(spark, schedule.time_features(F.lit(7), dim, style)), dim // 2
    freqs = np.exp(-math.log(10000) * np.arange(half) / (half - 1 if style == "sin_first" else half))
    waves = [np.sin(7 * freqs), np.cos(7 * freqs)]
    want = np.concatenate([*(waves if style == "sin_first" else waves[::-1]), np.zeros(dim % 2)])
    assert np.allclose(got, want)


def test_denoising_steps(spark):
    rng = np.random.default_rng(0)
    x, e, z = rng.normal(size=(3, 6))
    lit = lambda a: F.lit([float(v) for v in a])
    ab, ap, beta = 0.4, 0.7, 0.01
    got = one(spark, vec.ddpm_step(lit(x), lit(e), lit(z), F.lit(3), F.lit(beta), F.lit(1 - beta), F.lit(ab)))
    mean = (x - beta / math.sqrt(1 - ab) * e) / math.sqrt(1 - beta)
    assert np.allclose(got, mean + math.sqrt(beta) * z)
    at0 = one(spark, vec.ddpm_step(lit(x), lit(e), lit(z), F.lit(0), F.lit(beta), F.lit(1 - beta), F.lit(ab)))
    assert np.allclose(at0, mean)
    for eta in (0.0, 0.5):
        sigma = eta * math.sqrt((1 - ap) / (1 - ab)) * math.sqrt(1 - ab / ap)
        x0 = (x - math.sqrt(1 - ab) * e) / math.sqrt(ab)
        want = math.sqrt(ap) * x0 + math.sqrt(1 - ap - sigma**2) * e + sigma * z
        assert np.allclose(one(spark, vec.ddim_step(lit(x), lit(e), lit(z), F.lit(ab), F.lit(ap), eta)), want)


def test_guidance(spark):
    u, c = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(6.0))
    assert one(spark, vec.guided(u, c, 1)) == [3.0, 6.0]
    assert one(spark, vec.guided(u, c, 0)) == [3.0, 6.0]
    assert one(spark, vec.guided(u, c, 3.0)) == [7.0, 14.0]


def test_posterior(spark):
    x = [0.5, -0.5, -100.0, 100.0]
    got = one(spark, vec.sampled_posterior(F.lit(x), F.lit([1.0, 1.0])))
    assert got == pytest.approx([0.18215 * (0.5 + math.exp(-15)), 0.18215 * (-0.5 + math.exp(10))])


def test_shapes(spark):
    assert vec.latent_size(256) == 4096
    assert one(spark, vec.has_shape(F.lit([1.0] * 6), F.lit([2, 3]))) is True

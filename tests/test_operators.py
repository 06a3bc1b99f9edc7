from __future__ import annotations

import datetime
import math
import statistics
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.functions import rules, schedule
from corpusmill.operators import curation, models, noising, pairing, resume, runs, sampling, weights
from corpusmill.operators.sizing import broadcast_if_small
from corpusmill.plans import reports, training
from corpusmill.plans.scan import scan_report
from corpusmill.session import scratch_folder
from corpusmill.sources import files as src
from corpusmill.sources import shards as store
from corpusmill.streaming import dedupe, ingest, monitor


@pytest.fixture(scope="module")
def corpus(spark):
    """A third of all rows share one content; some rows have no content or bad sizes."""
    rows = []
    for i in range(300):
        content = None if i % 50 == 7 else b"same" if i % 3 == 0 else f"c{i % 90}".encode()
        rows.append((i, None if i % 41 == 0 else 300, 100 if i % 11 == 0 else 300, content))
    return spark.createDataFrame(rows, "id bigint, width int, height int, content binary").repartition(7), rows


def checks():
    return rules.size_rules(F.col("width"), F.col("height"))


def judged_by_loop(rows):
    seen, out = set(), {}
    for i, w, h, content in rows:
        if w is None or h is None:
            out[i] = "corrupt_or_unreadable"
        elif min(w, h) < 256:
            out[i] = "too_small"
        elif not 0.5 <= w / h <= 2.0:
            out[i] = "bad_aspect_ratio"
        elif content is None:
            out[i] = "hash_fail"
        elif content in seen:
            out[i] = "duplicate_sha1"
        else:
            seen.add(content)
            out[i] = None
    return out


def test_judge(corpus):
    df, rows = corpus
    want = judged_by_loop(rows)
    judged = curation.judge(df, checks(), "id", F.col("content"))
    assert {r.id: r.reason for r in judged.collect()} == want
    counts = [(r.reason, r.n) for r in curation.reason_counts(judged, "id").collect()]
    assert counts == Counter(want[i] for i in sorted(want) if want[i]).most_common()
    summary = curation.funnel_summary(judged).head()
    assert summary.candidates == summary.valid + summary.rejected == 300


def test_groups_give_the_same_counts(corpus):
    df, rows = corpus
    want = judged_by_loop(rows)
    report = scan_report(df, checks(), "id", F.col("content"), include_ok=True)
    assert {r.reason: r.n for r in report.reasons.collect()} == Counter(v or "ok" for v in want.values())
    assert sorted(r.id for r in report.valid.collect()) == [i for i in want if want[i] is None]
    assert tuple(report.summary.head()) == (300, sum(v is None for v in want.values()), sum(v is not None for v in want.values()))


def test_keepers_against_a_window(corpus):
    df, _ = corpus
    hashed = df.select("id", F.sha1("content").alias("h")).filter("h IS NOT NULL")
    first = F.row_number().over(Window.partitionBy("h").orderBy("id"))
    want = sorted(r.id for r in hashed.withColumn("rn", first).filter("rn = 1").collect())
    assert sorted(r.kept for r in curation.keepers(hashed, "h", "id").collect()) == want


def test_without_dedupe(corpus):
    df, rows = corpus
    report = scan_report(df, checks(), "id")
    assert "duplicate_sha1" not in {r.reason for r in report.reasons.collect()}


def test_pairing(spark):
    images = spark.createDataFrame([("d/a.jpg",), ("d/a.png",), ("d/b.jpg",), ("c.d/e.jpg",)], "path string")
    texts = spark.createDataFrame([("d/a.txt", " x\ty "), ("c.d/e.txt", "")], "path string, caption string")
    got = sorted((r.path, r.caption) for r in pairing.pair_by_stem(images, texts, F.col("caption")).collect())
    assert got == [("c.d/e.jpg", ""), ("d/a.jpg", "x y"), ("d/a.png", "x y")]


def test_resume_compares_normalised_paths(spark):
    rows = spark.createDataFrame([("a.jpg",), ("./b.jpg",), ("c.jpg",)], "path string")
    done = spark.createDataFrame([("./a.jpg",), ("b.jpg",)], "path string")
    assert [r.path for r in resume.resume_remaining(rows, done).collect()] == ["c.jpg"]
    first = resume.max_items(rows, 2, ["path"])
    assert sorted(r.path for r in first.collect()) == ["./b.jpg", "a.jpg"]
    assert resume.max_items(rows, 0, ["path"]).count() == 3


def test_next_archives(spark):
    done = spark.createDataFrame([(2,), (3,), (7,)], "id bigint")
    ids = lambda *a: [r.archive for r in resume.next_archives(done, *a).orderBy("id").collect()]
    assert ids(2) == ["00008", "00009"]
    assert ids(7, "gaps") == ["00000", "00001", "00004", "00005", "00006", "00008", "00009"]
    assert ids(1, "gaps") == ["00000"]
    assert [r.id for r in resume.next_archives(done.limit(0), 2).orderBy("id").collect()] == [0, 1]
    assert [r.id for r in resume.next_archives(done.limit(0), 2, "gaps").orderBy("id").collect()] == [0, 1]


def test_next_shard_beyond_five_digits(spark):
    names = spark.createDataFrame([("shard_99999.pt",), ("shard_100000.pt",), ("shard_7.pt",)], "name string")
    assert resume.next_shard(names, F.col("name")).first()["next"] == 100_001


def test_next_run_name(spark):
    names = spark.createDataFrame([("training_01_02_2024_run_01",), ("training_01_02_2024_run_12",), ("other",)], "name string")
    assert resume.next_run_name(names, datetime.date(2024, 1, 2)) == "training_01_02_2024_run_13"
    assert resume.next_run_name(names, datetime.date(2024, 1, 3)) == "training_01_03_2024_run_01"


def test_list_checkpoints(spark):
    names = spark.createDataFrame([(f"x/unet_step_{i:05d}.pt",) for i in range(13)] + [("x/unet_latest.pt",)], "name string")
    got = src.list_checkpoints(names).collect()
    assert [r.step for r in got] == list(range(12, 2, -1)) and got[0].older == 3
    assert src.latest_checkpoint(names).count() == 1 and src.latest_checkpoint(names.limit(3)).count() == 0


def test_list_shards(spark):
    listing = spark.createDataFrame([(f"p/{i % 9}.pt",) for i in range(20)] + [("p/x.json",)], "path string")
    order = [r.path for r in src.list_shards(listing, seed=4).orderBy("position").collect()]
    assert sorted(order) == [f"p/{i}.pt" for i in range(9)] and order != sorted(order)
    assert [r.path for r in src.list_shards(listing, seed=4, max_shards=3).orderBy("position").collect()] == order[:3]
    with pytest.raises(ValueError, match="no .zip shards"):
        src.list_shards(listing, ".zip")


def test_sample_and_shuffle(spark, monkeypatch):
    df = spark.range(500)
    few = sorted(r.id for r in sampling.sample_n(df, 40, ["id"]).collect())
    assert len(set(few)) == 40
    monkeypatch.setattr(sampling, "TOP_N_LIMIT", 10)
    assert sorted(r.id for r in sampling.sample_n(df.repartition(5), 40, ["id"]).collect()) == few
    assert sampling.sample_n(df, 1000, ["id"]).count() == 500


@pytest.fixture(scope="module")
def small_shards(spark):
    rows = [(f"d{i % 2}", i // 8, (i % 8) // 2, [float(i), 1.0, -1.0], i % 10) for i in range(40)]
    return spark.createDataFrame(rows, "dataset string, shard bigint, index bigint, x array<double>, y int")


@pytest.mark.parametrize("limit", [0, 500_000])
def test_training_table(spark, small_shards, monkeypatch, limit):
    monkeypatch.setattr("corpusmill.operators.sampling.broadcast_if_small", lambda df: broadcast_if_small(df, limit))
    steps = training.session_steps(spark, 100, 20)
    sched = training.default_schedule(spark, 50)

    def rows(n):
        table = training.training_table(small_shards.repartition(n), steps, sched, batch=4, timesteps=50, seed=3)
        return sorted((r.step, r.slot, r.dataset, r.shard, r["index"], r.t, tuple(r.xt)) for r in table.collect())

    got = rows(1)
    assert got == rows(5) and len(got) == 80
    shard_of_step = {(s, d, k) for s, _, d, k, *_ in got}
    assert len(shard_of_step) == 20 and Counter((d, k) for _, d, k in shard_of_step) == {(d, k): 2 for d in ("d0", "d1") for k in range(5)}


def test_draws_by_sample(spark):
    draws = sampling.draw_slots_by_sample(spark.range(50).withColumnRenamed("id", "step"), 7, 20, 10, 1)
    counts = Counter(r.ordinal for r in draws.collect())
    assert set(counts) == set(range(7)) and sum(counts.values()) == 1000


def test_label_dropout(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 5 != 0, (F.col("id") % 10).cast("int")).alias("y"))
    rows = sampling.drop_labels(df, "y", ["id"], p=0.1).collect()
    assert all(r.y_in in (r.y, 10) for r in rows) and all(r.y_in == 10 for r in rows if r.y is None)
    dropped = sum(r.y_in == 10 for r in rows if r.y is not None)
    assert 180 < dropped < 300


def test_epoch_batches(spark):
    df = spark.range(50)
    rows = sampling.epoch_batches(df, ["id"], 8, 3, partitions=4).collect()
    assert Counter((r.epoch, r.batch) for r in rows) == {(e, b): 8 for e in range(3) for b in range(6)}
    orders = [[r.id for r in sorted(rows, key=lambda r: r.ordinal) if r.epoch == e] for e in range(3)]
    assert orders[0] != orders[1] and all(len(set(o)) == 48 for o in orders)
    assert sampling.epoch_batches(df, ["id"], 8, 1, drop_last=False).count() == 50


def test_complete_batches_by_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(7)] + [("b", i) for i in range(4)], "g string, ordinal bigint")
    got = Counter(r.g for r in sampling.complete_batches(df, 3, by=["g"]).collect())
    assert got == {"a": 6, "b": 3}


def test_every_n(spark):
    assert [r.id for r in sampling.every_n(spark.range(7), "id", 3).collect()] == [0, 3, 6]
    assert sampling.every_n(spark.range(7), "id", 0).count() == 0


def test_mse_is_over_elements(spark):
    df = spark.createDataFrame([([1.0], [0.0]), ([0.0] * 3, [0.0] * 3)], "p array<double>, q array<double>")
    assert tuple(noising.mse(df, "p", "q").head()) == (2, 0.25)


def test_guided_branches(spark):
    df = spark.createDataFrame([(1, 3, [1.0]), (2, None, [2.0])], "s int, y int, x array<double>")
    both = noising.guidance_inputs(df, "y").withColumn("pred", F.transform("x", lambda v: v * F.col("y")))
    got = {r.s: r.pred for r in noising.combine_branches(both, 2.0, ["s"]).collect()}
    assert got == {1: [10 + 2 * (3 - 10.0)], 2: [20.0]}


def test_x0_is_recovered(spark, small_shards):
    rows = noising.noised(small_shards.withColumn("t", F.col("y") * 5), training.default_schedule(spark, 50), ["dataset", "shard", "index"], 1, method="xxhash")

    def exact():
        def model(xt, t):
            return xt

        return model

    scored = models.score_noise(rows.withColumn("t", F.col("t").cast("double")), exact, ("xt", "t"), 3)
    assert all(np.allclose(r.pred, r.xt) for r in scored.collect())


def test_describe(spark):
    rng = np.random.default_rng(2)
    a = np.where(rng.random(400) < 0.4, 5.0, rng.normal(100, 3, 400))
    pdf = pd.DataFrame({"a": a, "b": np.arange(400) * 1.5})
    pdf.loc[::17, "b"] = np.nan
    got = {r["column"]: r for r in runs.describe_exact(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    for name, want in pdf.describe().items():
        row = got[name]
        values = [row["count"], row["mean"], row["std"], row["min"], row.q25, row.q50, row.q75, row["max"]]
        assert values == pytest.approx(want.tolist(), rel=1e-12)


def test_describe_small(spark):
    one = spark.createDataFrame([(3.0,)], "x double")
    row = runs.describe_exact(one, ["x"]).head()
    assert (row["count"], row["std"], row.q25, row.q75) == (1, None, 3.0, 3.0)
    empty = runs.describe_exact(one.filter("x > 9"), ["x"]).head()
    assert (empty["count"], empty["mean"], empty.q50) == (0, None, None)
    near = runs.describe_exact(spark.range(1001), ["id"], approximate=True).head()
    assert near.q50 == 500.0 and near["std"] == pytest.approx(statistics.stdev(range(1001)))


@pytest.mark.parametrize("inside", [100_000, 7])
def test_quantiles_of_all_shapes(spark, monkeypatch, inside):
    """A value that a third of all rows share, heavy tails, infinities, NULL and NaN; brackets narrowed down to few rows."""
    monkeypatch.setattr(runs, "INSIDE", inside)
    monkeypatch.setattr(runs, "ACCURACY", 20)
    rng = np.random.default_rng(4)
    n = 3000
    shapes = {
        "hot": np.where(rng.random(n) < 0.34, 5.0, rng.normal(5, 3, n)),
        "tail": 10.0 ** rng.uniform(-200, 200, n) * rng.choice([-1, 1], n),
        "whole": rng.integers(-3, 4, n).astype(float),
        "ends": np.where(rng.random(n) < 0.3, np.inf, np.where(rng.random(n) < 0.2, -np.inf, rng.random(n))),
        "holes": np.where(rng.random(n) < 0.5, np.nan, rng.random(n)),
    }
    frame = spark.createDataFrame(pd.DataFrame(shapes)).withColumn("some", F.expr("case when whole = 0 then null else tail end")).repartition(3).cache()
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {(r["column"], r.prob): r.value for r in runs.exact_quantiles(frame, [*shapes, "some"], probs).collect()}
    shapes["some"] = shapes["tail"][shapes["whole"] != 0]
    for name, values in shapes.items():
        kept = np.sort(values[~np.isnan(values)])
        for p in probs:
            at = p * (len(kept) - 1)
            a, b = kept[math.floor(at)], kept[math.ceil(at)]
            assert got[name, p] == pytest.approx(a if a == b else a + (b - a) * (at - math.floor(at)), rel=1e-12), (name, p)


def test_shard_coverage_totals(spark):
    log = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "step int, shard string")
    assert runs.coverage_totals(log, topk=1).collect() == [(4, 3, 1, 2, 1)]
    assert runs.coverage_totals(log.limit(0)).collect() == [(0, 0, 0, 0, 0)]


def test_shard_coverage_ties(spark):
    log = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, "c")], "step int, shard string")
    rows = runs.shard_coverage(log, topk=2).collect()
    assert [(r.shard, r.n, r.percent, r.hidden) for r in rows] == [("b", 2, 40.0, 1), ("a", 2, 40.0, 1)]


def test_shard_coverage_leaves_out_lines_without_shard(spark):
    log = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None), (2, None)], "step int, shard string")
    rows = runs.shard_coverage(log).collect()
    assert [(r.shard, r.n, r.percent, r.hidden) for r in rows] == [("a", 1, 50.0, 0), ("b", 1, 50.0, 0)]


@pytest.mark.parametrize("budget", [0, 9, 10, 25, 1000])
def test_retention_against_a_cache(spark, budget):
    sizes = [5, 10, 3, 7, 1, 30, 2]
    accesses = [0, 1, 2, 0, 3, 5, 4, 1, 6, 2]
    held: dict[int, int] = {}
    for name in accesses:
        held.pop(name, None)
        held[name] = sizes[name]
    while held and sum(held.values()) > budget:
        held.pop(next(iter(held)))
    log = spark.createDataFrame([(n, i, sizes[n]) for i, n in enumerate(accesses)], "name int, ts int, bytes bigint")
    kept = runs.retain_within_budget(runs.last_access(log), budget, partitions=3)
    assert {r.name for r in kept.filter("kept").collect()} == set(held)


def test_log_report(spark):
    log = spark.createDataFrame([(s, float(s % 7), f"s{s % 3}") for s in range(100)], "step bigint, loss double, shard string")
    report = reports.log_report(log)
    want = pd.Series([float(s % 7) for s in range(100)]).ewm(alpha=0.02, adjust=False).mean()
    assert np.allclose([r.ema for r in report.smoothed.orderBy("step").collect()], want)
    assert {r["column"] for r in report.summary.collect()} == {"step", "loss", "ema"}
    assert report.coverage.count() == 3


def test_log_report_with_one_step_only(spark):
    log = spark.createDataFrame([(1, float(i), "s") for i in range(60)], "step bigint, loss double, shard string")
    rows = reports.log_report(log.coalesce(1), alpha=0.5).smoothed.collect()
    want = pd.Series([float(i) for i in range(60)]).ewm(alpha=0.5, adjust=False).mean()
    assert np.allclose(sorted(r.ema for r in rows), sorted(want))


def test_diff_totals_of_nothing(spark):
    a = spark.createDataFrame([("w", [1], [1.0])], "param string, shape array<int>, values array<double>")
    b = a.withColumn("param", F.lit("v"))
    assert tuple(weights.diff_totals(weights.layer_norms(a, b)).head()) == (0, 0, 0.0, 0.0)
    assert {r.param: r.side for r in weights.key_sides(a, b).collect()} == {"w": "only_a", "v": "only_b"}


def test_shard_read_default_scale(spark, workdir):
    rows = [("p1", "c", [0.5], None), ("p2", "c", [0.5], 0.3)]
    df = spark.createDataFrame(rows, "path string, caption string, latent array<float>, latent_scale double").selectExpr(
        "*", "array(1) shape", "256 image_size", "'e' encoder_id", "'d' dataset"
    )
    store.write_shards(df, f"{workdir}/s", size=1)
    got = {r.path: (r.shard, r.latent_scale) for r in store.read_shards(spark, f"{workdir}/s", ["d"]).collect()}
    assert got == {"p1": (0, 0.18215), "p2": (1, 0.3)}


# --- streams --------------------------------------------------------------------------------------


def stream_of(spark, workdir, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{workdir}/in/{i}")
    return ingest.file_stream(spark, f"{workdir}/in/*", schema, per_trigger=1)


def test_dedupe_stream(spark, workdir):
    stream = stream_of(spark, workdir, [[(1, "a"), (2, "b")], [(3, "a"), (4, "c")], [(5, "c")]], "id int, text string")
    ingest.ingest_available(dedupe.dedupe_stream(stream, F.col("text")), f"{workdir}/out", f"{workdir}/check")
    assert {r.text for r in spark.read.parquet(f"{workdir}/out").collect()} == {"a", "b", "c"}
    assert spark.read.parquet(f"{workdir}/out").count() == 3


def test_dedupe_stream_after_a_batch(spark, workdir):
    """Contents of the batch are dropped, at the first batch and after a restart; exact integers and NULLs pass; the state lists all hashes."""
    big = 2**60 + 1
    stream = stream_of(spark, workdir, [[(big, "a"), (None, "b"), (3, None)], [(4, "b"), (5, "c"), (6, None)]], "id bigint, text string")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "text string").select(F.sha1("text").alias("sha1"))
    with dedupe.state_in_rocksdb(spark):
        new = dedupe.dedupe_stream_after(stream, F.col("text"), known)
        ingest.ingest_available(new, f"{workdir}/out", f"{workdir}/check")
        read = lambda: sorted(((r.id, r.text) for r in spark.read.parquet(f"{workdir}/out").collect()), key=str)
        # Which of two files comes first is up to their times.
        assert [t for _, t in sorted(read(), key=lambda x: str(x[1]))] == [None, "b", "c"] and dedupe.seen_contents(spark, f"{workdir}/check").count() == 4
        spark.createDataFrame([(big, "d"), (8, "a"), (9, "c")], "id bigint, text string").coalesce(1).write.parquet(f"{workdir}/in/9")
        ingest.ingest_available(new, f"{workdir}/out", f"{workdir}/check")
    assert (big, "d") in read() and len(read()) == 4
    assert spark.conf.get(dedupe.PROVIDER) != dedupe.ROCKSDB


def test_smoothed_loss_stream(spark, workdir):
    batches = [[("r", 2, 4.0), ("r", 1, 2.0), ("q", 1, 1.0)], [("r", 3, 8.0)]]
    stream = stream_of(spark, workdir, batches, "run string, step bigint, loss double")
    ingest.ingest_available(monitor.smoothed_loss(stream, alpha=0.5), f"{workdir}/out", f"{workdir}/check")
    got = {(r.run, r.step): r.ema for r in spark.read.parquet(f"{workdir}/out").collect()}
    assert set(got) == {("r", 1), ("r", 2), ("r", 3), ("q", 1)}
    assert got[("r", 2)] == 3.0 and got[("r", 3)] == 5.5


def test_scratch_folder_is_below_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "x").startswith(base) and scratch_folder(spark, "x") != scratch_folder(spark, "x")


def test_schedule_is_bounded(spark):
    with pytest.raises(ValueError):
        schedule.noise_schedule(spark, schedule.MAX_STEPS + 1)

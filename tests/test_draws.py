"""Weighted draws, payload read by drawn rows, and smoothing on a stream."""

from __future__ import annotations

import math
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import sampling
from corpusmill.plans import training
from corpusmill.sources import shards
from corpusmill.streaming import ingest, monitor


@pytest.fixture(scope="module")
def samples(spark):
    """Three shards; one holds most of the weight, some samples have none."""
    rows = [("d", s, i, {0: 0.1 * i, 1: 40.0, 2: None if i % 2 else 1.0}[s]) for s in range(3) for i in range(8)]
    return spark.createDataFrame(rows, "dataset string, shard int, index bigint, weight double")


def test_weighted_draws_match_the_weights(spark, samples):
    draw = lambda parts, seed=3: sampling.draw_slots_weighted(spark.range(2000).withColumnRenamed("id", "step").repartition(parts), samples.repartition(parts), 10, 50, seed)
    got = draw(5).collect()
    assert len(got) == 20_000 and {r.slot for r in got} == set(range(10)) and {r.t for r in got} == set(range(50))
    weight = {(r.shard, r["index"]): r.weight or 0.0 for r in samples.collect()}
    total = sum(weight.values())
    counts = Counter((r.shard, r["index"]) for r in got)
    for key, w in weight.items():
        want = 20_000 * w / total
        assert abs(counts[key] - want) <= 5 * math.sqrt(want) + 1e-9, key
    assert sorted(map(tuple, got)) == sorted(map(tuple, draw(1).collect()))
    assert sorted(map(tuple, got)) != sorted(map(tuple, draw(5, 4).collect()))
    with pytest.raises(ValueError, match="weight"):
        sampling.draw_slots_weighted(spark.range(1).withColumnRenamed("id", "step"), samples.withColumn("weight", F.lit(0)), 1, 1, 0)


def test_row_groups_of_drawn_rows(workdir):
    path = f"{workdir}/shard.parquet"
    pq.write_table(pa.table({"index": list(range(100))}), path, row_group_size=10)
    metadata = pq.ParquetFile(path).metadata
    found = shards.groups_of(metadata, np.array([0, 3, 3, 55, 99]))
    assert [(g, at.tolist()) for g, at in found] == [(0, [0, 1, 2]), (5, [3]), (9, [4])]
    assert shards.groups_of(metadata, np.array([100])) == []


@pytest.fixture(scope="module")
def store(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for first, precision in ((0, "fp32"), (100, "fp16")):
        rows = [("d" if i % 3 else "e", f"p{i}", [float(i % 50), 0.5]) for i in range(first, first + 100)]
        frame = spark.createDataFrame(rows, "dataset string, path string, latent array<float>").select(
            "path", F.lit("c").alias("caption"), "latent", F.array(F.lit(2)).alias("shape"), F.lit(16).alias("image_size"), F.lit("e").alias("encoder_id"),
            F.lit(1.0).alias("latent_scale"), "dataset",
        )
        shards.write_shards(frame, root, size=20, precision=precision)
    return root


@pytest.mark.parametrize("per_task", [3, 5000])
def test_gather_stored(spark, store, monkeypatch, per_task):
    monkeypatch.setattr(shards, "TASK_DRAWS", per_task)
    stored = shards.read_shards(spark, store)
    draws = training.training_draws(stored, training.session_steps(spark, 0, 40), 5, 10, 1, method="md5")
    want = sampling.gather_samples(draws, stored).select("step", "slot", "dataset", "shard", "index", "t", "path", "latent")
    got = shards.gather_stored(draws, store).select(want.columns)
    rows = sorted(map(tuple, got.collect()))
    assert len(rows) == 200 and rows == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above and "FileScan" not in plan


def test_gather_of_few_draws_opens_their_shards_only(spark, store):
    draws = spark.createDataFrame([(0, 0, "d", 1, 3), (0, 1, "d", 1, 3), (1, 0, "d", 1, 99), (1, 1, "none", 0, 0)], "step int, slot int, dataset string, shard int, index bigint")
    got = shards.gather_stored(draws, store, ["path"]).collect()
    assert len(got) == 2 and len({r.path for r in got}) == 1
    assert shards.gather_stored(draws.limit(0), store).count() == 0


def test_stored_training_rows(spark, store):
    draws = training.training_draws(shards.read_shards(spark, store), training.session_steps(spark, 0, 6), 4, 10, 1, method="md5")
    rows = training.stored_training_rows(store, draws, training.default_schedule(spark, 10)).collect()
    assert len(rows) == 24
    for r in rows:
        assert np.allclose(r.xt, np.array(r.latent) * r.sqrt_ab + np.array(r.eps) * r.sqrt_one_minus_ab)


def loop(values, alpha):
    out, v = [], None
    for x in values:
        v = x if v is None else alpha * v + (1 - alpha) * x
        out.append(v)
    return out


def smoothed(spark, workdir, name, batches, **options):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "run string, step bigint, loss double").coalesce(1).write.parquet(f"{workdir}/{name}/in{i}")
        stream = ingest.file_stream(spark, f"{workdir}/{name}/in*", "run string, step bigint, loss double", per_trigger=1)
        ingest.ingest_available(monitor.smoothed_loss(stream, 0.5, **options), f"{workdir}/{name}-out", f"{workdir}/{name}-check")
    return {(r.run, r.step): r.ema for r in spark.read.parquet(f"{workdir}/{name}-out").collect()}


def test_smoothing_does_not_depend_on_chunks(spark, workdir):
    order = np.random.default_rng(1).permutation(60).tolist()
    rows = [("hot" if i % 4 else "b", i, float(i * i % 17)) for i in order]
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    try:
        for size in (1, 3, 100):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            found.append(smoothed(spark, workdir, f"c{size}", [rows]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert found[0] == found[1] == found[2] and len(found[0]) == 60
    for run in ("hot", "b"):
        own = sorted((s, x) for r, s, x in rows if r == run)
        assert [found[0][run, s] for s, _ in own] == pytest.approx(loop([x for _, x in own], 0.5))


def test_smoothing_holds_little_for_a_row(monkeypatch):
    """A run of a micro-batch is given back in blocks that go on from each other, in less than 64 bytes for each row."""
    class Run:
        def groupBy(self, _):
            return self

        def applyInPandasWithState(self, fold, *_):
            self.fold = fold
            return self

    class State:
        exists, got = False, None

        def update(self, got):
            self.got = got

    monkeypatch.setattr(monitor, "every_n", lambda df, *_: df)
    n, state = 600_000, State()
    fold = monitor.smoothed_loss(Run(), 0.5).fold
    order = np.random.default_rng(2).permutation(n)
    chunks = (pd.DataFrame({"run": "r", "step": order[i : i + 10_000], "loss": order[i : i + 10_000] % 7.0}) for i in range(0, n, 10_000))
    tracemalloc.start()
    try:
        ends = [(len(f), f["ema"].iloc[-1], f["step"].iloc[-1]) for f in fold(("r",), chunks, state)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(k for k, _, _ in ends) == n and max(k for k, _, _ in ends) < n / 4 and peak < 64 * n
    assert ends[-1][1:] == (pytest.approx(loop([i % 7.0 for i in range(n)], 0.5)[-1]), n - 1) and state.got[:3] == (ends[-1][1], n - 1, n - 1)


def test_smoothing_waits_for_late_rows(spark, workdir):
    batches = [[("r", 1, 2.0), ("r", 4, 8.0)], [("r", 2, 4.0), ("r", 9, 1.0)], [("r", 3, 6.0), ("r", 30, 0.0)]]
    got = smoothed(spark, workdir, "late", batches, lateness=5)
    # 3 comes when 4 is shown already; 30 still waits.
    assert got[("r", 3)] is None and set(s for _, s in got) == {1, 2, 3, 4, 9}
    assert [got["r", s] for s in (1, 2, 4, 9)] == pytest.approx(loop([2.0, 4.0, 8.0, 1.0], 0.5))

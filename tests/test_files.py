"""Readers, writers and plans on generated files."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import fixtures as fx
from corpusmill.catalog import QUERIES
from corpusmill.functions.paths import basename
from corpusmill.operators import models
from corpusmill.plans import ingest, reports
from corpusmill.plans.scan import scan_corpus
from corpusmill.plans.shards import build_shards, manifest_check
from corpusmill.sources import archives, checkpoints, files, shards, text
from corpusmill.streaming.ingest import ingest_archive_stream


def names(df, column="path"):
    return sorted(r[0] for r in df.select(basename(F.col(column))).collect())


def test_scan_files(spark, workdir):
    root = fx.image_tree(f"{workdir}/raw")
    assert names(files.scan_files(spark, root)) == [
        "a.png", "copy.PNG", "cut.png", "other.png", "small.png", "text.jpg", "wide.png",
    ]


def test_read_images(spark, workdir):
    root = fx.image_tree(f"{workdir}/raw")
    got = {r.path.rsplit("/", 1)[1]: r for r in files.read_images(spark, root).collect()}
    assert tuple(got["other.png"].verdict) == (True, "ok", 9, 8)
    assert tuple(got["cut.png"].verdict) == (False, "corrupt_or_unreadable", None, None)
    assert not got["text.jpg"].verdict.ok
    pixels = models.bgr_rows(bytes(got["other.png"].data), 8, 9, 3)
    assert (pixels == fx.read_png(fx.png(9, 8, 2))).all()


@pytest.mark.parametrize("dedupe", [False, True])
def test_scan_corpus(spark, workdir, dedupe):
    root = fx.image_tree(f"{workdir}/raw")
    out = f"{workdir}/out"
    scan = scan_corpus(spark, root, out, min_side=8, dedupe=dedupe)
    reasons = {r.reason: r.n for r in scan.report.reasons.collect()}
    want = {"corrupt_or_unreadable": 2, "too_small": 1, "bad_aspect_ratio": 1}
    assert reasons == (want | {"duplicate_sha1": 1} if dedupe else want)
    summary = scan.report.summary.head()
    assert summary.candidates == summary.valid + summary.rejected == 7
    kept = ["a.png", "other.png"] if dedupe else ["a.png", "copy.PNG", "other.png"]
    listed = text.read_filelist(spark, f"{out}/filelist")
    assert names(listed) == kept and {r.caption for r in listed.collect()} == {""}


def test_scan_corpus_lists_stored_paths(spark, workdir):
    root = fx.image_tree(f"{workdir}/raw")
    scan_corpus(spark, root, f"{workdir}/out", min_side=8, store=True)
    listed = sorted(r.path for r in text.read_filelist(spark, f"{workdir}/out/filelist").collect())
    assert listed[0] == f"{workdir}/out/images/a.png" and listed[2] == f"{workdir}/out/images/sub/other.png"


def test_small_files_share_tasks(spark, workdir, sf_dir):
    """Images are not read a few to a task; the setting that deals them is put back."""
    fx.write(f"{workdir}/raw/one.txt", "x")
    for i in range(200):
        fx.write(f"{workdir}/raw/{i}.png", fx.png(9, 8, i))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", files.OPEN_COST)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        scan = scan_corpus(spark, f"{workdir}/raw", f"{workdir}/out", min_side=8)
        found = [scan.judged, QUERIES["image_files"](spark, sf_dir)]
        assert spark.conf.get(files.OPEN_COST) == kept[files.OPEN_COST]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept["spark.sql.files.maxPartitionBytes"])
    assert [df.count() for df in found] == [200, spark.read.parquet(f"{sf_dir}/documents.parquet").count()]
    assert max(df.rdd.getNumPartitions() for df in found) <= 16


def reads(monkeypatch, name):
    """How many files each call of a reader lists, and no more than 60 at once."""
    listed, read = [], getattr(files, name)

    def counted(*args):
        listed.append(len((found := read(*args)).inputFiles()))
        return found

    monkeypatch.setattr(files, name, counted)
    monkeypatch.setattr(files, "FILES_AT_ONCE", 60, raising=False)
    return listed


def test_images_are_decoded_a_number_of_files_at_a_time(spark, sf_dir, workdir, monkeypatch):
    """The driver holds the listing of one read, not of the folder."""
    want = {tuple(r) for r in QUERIES["image_files"](spark, sf_dir).collect()}
    listed = reads(monkeypatch, "read_images")
    rows = QUERIES["image_files"](spark, sf_dir).collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(want) == sum(listed)
    assert max(listed) <= 60 < sum(listed)


def test_a_folder_is_scanned_a_number_of_files_at_a_time(spark, workdir, monkeypatch):
    for i in range(150):
        fx.write(f"{workdir}/raw/{i:03d}.png", fx.png(9, 8 if i % 3 else 7, i % 100) if i % 10 else "no image")
    judged = [{tuple(r) for r in scan_corpus(spark, f"{workdir}/raw", f"{workdir}/one", min_side=8, dedupe=True).judged.collect()}]
    listed = reads(monkeypatch, "read_files")
    scan = scan_corpus(spark, f"{workdir}/raw", f"{workdir}/out", min_side=8, dedupe=True)
    judged.append({tuple(r) for r in scan.judged.collect()})
    assert judged[0] == judged[1] and max(listed) <= 60 < sum(listed) == 150
    both = [sorted(r.path for r in text.read_filelist(spark, f"{workdir}/{x}/filelist").collect()) for x in ("one", "out")]
    assert both[0] == both[1] and len(both[0]) == scan.report.valid.count()


def odd_tree(root):
    """Names that file sources leave out, and odd ones that they read."""
    for name in (*ODD, "_x=1/a.png", "_metadata.png", "sub/deep/b.JPG", "sub/c.txt", "[x]/d.png", "back\\slash.png"):
        fx.write(f"{root}/{name}", fx.png(9, 8, 1))
    for name in (".h.png", "_h.png", "_h/x.png", ".h/x.png", "sub/_y/x.png", "n.png._COPYING_"):
        fx.write(f"{root}/{name}", fx.png(9, 8, 1))
    os.symlink(f"{root}/sub/c.txt", f"{root}/link.png")
    os.symlink(f"{root}/nothing", f"{root}/broken.png")
    os.symlink(f"{root}/sub/deep", f"{root}/linked")
    with open(os.fsencode(f"{root}/no text ") + b"\xff.png", "wb") as f:
        f.write(b"x")
    return root


def test_walk_finds_what_spark_lists(spark, workdir, monkeypatch):
    raw = odd_tree(f"{workdir}/raw")
    spark.conf.set("fs.viewfs.mounttable.walked.link./in", f"file://{workdir}")
    for root in (raw, f"file://{raw}/", f"{workdir}/r*", f"{raw}/{{sub,sub/deep}}", f"{raw}/sub/deep/b.JPG", f"{raw}/s*", "viewfs://walked/in/raw", f"{raw}/none*"):
        try:
            want = sorted(r.path for r in files.list_files(spark, root).select("path").collect())
        except AnalysisException:
            want = []
        spark_names = [f.replace("file:///", "file:/") for f in want]
        walked = [f for f in files.walk_files(spark, root) if not f.endswith("/_metadata.png")]
        assert sorted(walked) == spark_names, root
    assert list(files.walk_files(spark, f"{raw}/none")) == []


@pytest.mark.parametrize("reader", ["read_files", "read_images"])
def test_rounds_give_the_rows_of_one_read(spark, workdir, monkeypatch, reader):
    raw = odd_tree(f"{workdir}/raw")
    open(f"{raw}/empty.png", "w").close()
    read = getattr(files, reader)
    want = sorted(r.path for r in read(spark, raw).select("path").collect())
    monkeypatch.setattr(files, "FILES_AT_ONCE", 4)
    kept = {k: spark.conf.get(k) for k in (files.OPEN_COST, files.LOOKUP_TASKS, files.LOOKUP_KEPT)}
    got = files.read_in_rounds(spark, read, raw, lambda rows: rows.select("path"))
    assert sorted(r.path for r in got.collect()) == want and len(want) > 8
    assert {k: spark.conf.get(k) for k in kept} == kept
    for i in range(5):
        fx.write(f"{workdir}/texts/{i}.txt", "x")
    assert files.read_in_rounds(spark, read, f"{workdir}/texts", lambda rows: rows.select("path")).collect() == []
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_in_rounds(spark, read, f"{raw}/none", lambda rows: rows)


def test_scan_corpus_without_valid_files(spark, workdir):
    root = fx.image_tree(f"{workdir}/raw")
    with pytest.raises(ValueError, match="no valid images"):
        scan_corpus(spark, root, f"{workdir}/out", min_side=1000)


def test_pairs(spark, workdir):
    path = fx.write(f"{workdir}/pairs.tsv", "a.jpg\tone\n\nb.jpg\ttwo\tparts\nc.jpg\t\n")
    got = text.read_pairs(spark, path, ordinal=True).orderBy("ordinal").collect()
    assert [(r.ordinal, r.path, r.caption) for r in got][:2] == [(0, "a.jpg", "one"), (2, "b.jpg", "two\tparts")]
    assert got[2].caption == ""
    bad = fx.write(f"{workdir}/bad.tsv", "a.jpg\tone\nno tab\n")
    with pytest.raises(Exception, match="without a tab"):
        text.read_pairs(spark, bad).collect()
    assert text.read_pairs(spark, bad, "permissive").count() == 1
    assert [r.value for r in text.pair_rejects(text.read_lines(spark, bad)).collect()] == ["no tab"]


def test_line_order_over_files_and_splits(spark, workdir):
    for name, start in (("b", 300), ("a", 0)):
        fx.write(f"{workdir}/in/{name}.txt", "".join(f"line {i:05d}\n" for i in range(start, start + 300)))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = {r.ordinal: r.value for r in text.read_lines(spark, f"{workdir}/in", ordinal=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert got == {i: f"line {i:05d}" for i in range(600)}


def test_choose_input(spark, workdir):
    listed = fx.write(f"{workdir}/files.txt", " a.jpg \n\n\tb.jpg\n")
    assert names(text.choose_input(spark, f"{workdir}/none.tsv", listed)) == ["a.jpg", "b.jpg"]
    with pytest.raises(ValueError):
        text.choose_input(spark, f"{workdir}/none.tsv")
    pairs = fx.write(f"{workdir}/pairs.tsv", "c.jpg\tx\n")
    assert names(text.choose_input(spark, pairs, listed)) == ["c.jpg"]


def test_writers_round_trip(spark, workdir):
    rows = spark.createDataFrame([("b", "x\ty\nz"), ("a", None)], "path string, caption string")
    text.write_pairs(rows, f"{workdir}/pairs")
    got = {r.path: r.caption for r in text.read_pairs(spark, f"{workdir}/pairs").collect()}
    assert got == {"a": "", "b": "x y z"}
    for step in (10, 20):
        text.append_loss(spark.createDataFrame([(step, 0.5)], "step bigint, loss double"), f"{workdir}/loss")
    assert sorted(r.step for r in text.read_loss_csv(spark, f"{workdir}/loss").collect()) == [10, 20]
    text.mark_done(spark.createDataFrame([(7, "a.tar")], "archive_id bigint, archive string"), f"{workdir}/done", "0")
    assert spark.read.parquet(f"{workdir}/done").count() == 1


def test_manifest_reader_is_lenient(spark, workdir):
    path = fx.write(f"{workdir}/m.jsonl", '{"shard": "s", "index": 1, "path": "p", "caption": "é"}\n{"shard": "s"}\n{"shard": "s", "pa\nx\n')
    assert [(r.path, r["index"], r.caption) for r in text.read_manifest(spark, path).collect()] == [("p", 1, "é")]


def test_train_log(spark, workdir):
    lines = "noise\nstep 20 | loss 0.5 | shard b\nstep 10 | loss 1e-05 | 1.2s\x0bstep 30 | loss nan | shard a\nstep 5 | loss 1.2.3 | shard a\n"
    path = fx.write(f"{workdir}/log.txt", lines.encode() + b"step 40 | loss 2.5 | shard c\xffd\n")
    log = text.sorted_by_step(text.read_train_log(spark, path)).collect()
    assert [(r.step, r.shard) for r in log] == [(10, None), (20, "b"), (30, "a"), (40, "cd")]
    assert math.isnan(log[2].loss)
    counts = {r.kind: r.n for r in text.train_log_counts(text.read_lines(spark, path)).collect()}
    assert counts == {"unmatched": 1, "rejected": 1, "shard": 3, "seconds": 1}
    with pytest.raises(ValueError, match="no loss lines"):
        text.read_train_log(spark, fx.write(f"{workdir}/empty.txt", "nothing\n"))


def test_checkpoints(spark, workdir):
    rows = "param string, shape array<int>, values array<double>"
    flat = spark.createDataFrame([("w", [2], [1.0, 2.0]), ("v", [1], [3.0])], rows)
    entry = F.map_from_entries(F.collect_list(F.struct("param", F.struct("shape", "values"))))
    for name in ("model", "state"):
        flat.agg(entry.alias(name)).write.parquet(f"{workdir}/{name}")
        got = checkpoints.read_checkpoint_params(spark, f"{workdir}/{name}").collect()
        assert {(r.param, tuple(r.shape), tuple(r["values"])) for r in got} == {("w", (2,), (1.0, 2.0)), ("v", (1,), (3.0,))}
    with pytest.raises(ValueError, match="no parameters"):
        checkpoints.normalise_params(spark.range(1))


def test_checkpoint_blocks_give_the_same_report(spark):
    rng = np.random.default_rng(1)
    rows = [(f"p{i}", [40], rng.normal(size=40).tolist()) for i in range(6)]
    other = [(n, s, [v * 0.5 for v in vs]) for n, s, vs in rows[1:]] + [("p0", [2, 20], rows[0][2])]
    kind = "param string, shape array<int>, values array<double>"
    a, b = spark.createDataFrame(rows, kind), spark.createDataFrame(other, kind)
    whole = {r.param: r for r in reports.checkpoint_report(a, b).norms.collect()}
    cut = {r.param: r for r in reports.checkpoint_report(checkpoints.in_blocks(a, 7), checkpoints.in_blocks(b, 7)).norms.collect()}
    assert set(whole) == set(cut) == {f"p{i}" for i in range(1, 6)}
    for name, r in whole.items():
        assert (cut[name].l2, cut[name].linf, cut[name].n) == (pytest.approx(r.l2), r.linf, r.n)
        assert r.l2 == pytest.approx(np.linalg.norm([v * 0.5 for v in dict((n, v) for n, _, v in rows)[name]]))


def test_oldest_against_newest(spark):
    kind = "ckpt string, param string, shape array<int>, values array<double>"
    rows = [(f"unet_step_{i:04d}.pt", "w", [1], [float(i)]) for i in (10, 20, 30)]
    report = reports.compare_checkpoints(spark.createDataFrame(rows, kind))
    assert report.totals.head().sum_l2 == 20.0
    assert reports.compare_checkpoints(spark.createDataFrame(rows[:1], kind)) is None
    named = reports.compare_checkpoints(spark.createDataFrame(rows, kind), rows[0][0], rows[1][0])
    assert named.totals.head().max_linf == 10.0


# --- shards and archives --------------------------------------------------------------------------


def png_pairs(spark, root, n, dataset="set_0"):
    for i in range(n):
        fx.write(f"{root}/{i:03d}.png", b"broken" if i == 4 else fx.png(16, 16, i))
    rows = [(f"{root}/{i:03d}.png", f"caption {i}", dataset) for i in range(n)]
    return spark.createDataFrame(rows, "path string, caption string, dataset string")


def load_binary(spark, root):
    def load(rows):
        content = spark.read.format("binaryFile").load(root).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content")
        return rows.join(content, "path")

    return load


def build(spark, pairs, raw, root, **more):
    options = {"image_size": 16, "batch_size": 4, "shard_size": 3, "decoder": fx.read_png} | more
    return build_shards(pairs, load_binary(spark, raw), root, models.block_average(), **options).head()


def test_build_and_resume(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/store"
    pairs = png_pairs(spark, raw, 11)
    assert tuple(build(spark, pairs, raw, root, max_items=6)) == (5, 1)
    stored = shards.read_shards(spark, root)
    assert sorted((r.shard, r["index"], r.path[-7:]) for r in stored.collect()) == [
        (0, 0, "000.png"), (0, 1, "001.png"), (0, 2, "002.png"), (1, 0, "003.png"), (1, 1, "005.png"),
    ]
    assert tuple(build(spark, pairs, raw, root, resuming=True)) == (5, 1)
    assert sorted((r.shard, r["index"]) for r in shards.read_shards(spark, root).filter("shard > 1").collect()) == [
        (2, 0), (2, 1), (2, 2), (3, 0), (3, 1),
    ]
    assert tuple(build(spark, pairs, raw, root, resuming=True)) == (0, 1)
    manifest = shards.stored_manifest(spark, root)
    numbered = shards.read_shards(spark, root).withColumn("shard", F.format_string("shard_%05d", "shard"))
    assert tuple(manifest_check(manifest, numbered, ["dataset", "shard", "index"]).head()) == (0, 0, 0, 0)
    row = shards.read_shards(spark, root).filter(F.col("path").endswith("000.png")).head()
    pixels = fx.read_png(fx.png(16, 16, 0)) / 255 * 2 - 1
    want = pixels.transpose(2, 0, 1).reshape(3, 2, 8, 2, 8).mean(axis=(2, 4)) * 0.18215
    assert np.allclose(row.latent, want.ravel(), atol=1e-6) and row.shape == [3, 2, 2]


def test_resume_lists_what_a_stopped_run_left(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/store"
    pairs = png_pairs(spark, raw, 4)
    stored = models.drop_failed_encodes(
        models.encode_batches(load_binary(spark, raw)(pairs), models.block_average(), 16, 4, decoder=fx.read_png)
    )
    shards.write_shards(stored, root, size=3)
    assert shards.stored_manifest(spark, root).count() == 0
    assert tuple(build(spark, pairs, raw, root, resuming=True)) == (0, 0)
    assert shards.stored_manifest(spark, root).count() == 4 == shards.read_shards(spark, root).count()


def test_order_by_ordinal(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/store"
    pairs = png_pairs(spark, raw, 4).withColumn("ordinal", -F.substring("caption", 9, 3).cast("bigint"))
    build(spark, pairs, raw, root, order=["ordinal"])
    got = shards.read_shards(spark, root).orderBy("shard", "index").collect()
    assert [r.caption[-1] for r in got] == ["3", "2", "1", "0"]


def test_next_shard_per_dataset(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/store"
    for dataset in ("x", "y", "x"):
        pairs = png_pairs(spark, raw, 4, dataset).withColumn("path", F.col("path"))
        build(spark, pairs, raw, root)
    assert {r.dataset: r.next for r in shards.next_shard_numbers(spark, root).collect()} == {"x": 4, "y": 2}


def test_decode_and_precision(spark):
    x = spark.createDataFrame([([0.1, -2.0, 1.0],)], "x array<double>")
    half = models.cast_precision(F.col("x"))
    row = x.select(F.length(half).alias("n"), models.unpack_half(half).alias("back"), models.cast_precision(F.col("x"), "fp32").alias("f")).head()
    assert row.n == 6 and np.allclose(row.back, [0.1, -2.0, 1.0], atol=1e-3) and np.allclose(row.f, [0.1, -2.0, 1.0])


def test_resize_keeps_flat_images_and_crops_the_centre():
    flat = np.full((10, 30, 3), 77, dtype=np.uint8)
    flat[:, :10] = flat[:, 20:] = 0
    assert (models.crop_and_resize(flat, 4) == 77).all()
    assert models.crop_and_resize(fx.read_png(fx.png(20, 20)), 64).shape == (64, 64, 3)
    ramp = np.repeat(np.arange(64, dtype=np.uint8)[None, :, None], 64, 0).repeat(3, 2)
    assert np.allclose(models.crop_and_resize(ramp, 32)[8, 4:28, 0], np.arange(4, 28) * 2 + 0.5, atol=0.6)


@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_expand_archives(spark, workdir, chunk):
    path = fx.archive(f"{workdir}/tars/00012.tar", 10)
    found = archives.list_archives(spark, f"{workdir}/tars")
    rows = archives.expand_archives(found, chunk).collect()
    by_name = {r.member: r for r in rows}
    assert len(rows) == 11 and by_name["000010.png"].content == fx.png(16, 16, 10)
    row = by_name["000010.txt"]
    assert (row.archive_id, row.key, row.ext) == (12, "000010", ".txt") and row.archive.endswith(path)


def settings(root):
    return ingest.IngestSettings(
        root, models.block_average(), fx.read_png, image_size=16, batch_size=4, shard_size=3, limits={"min_side": 16}
    )


def test_ingest_next(spark, workdir):
    for i in (0, 1, 3):
        fx.archive(f"{workdir}/tars/{i:05d}.tar", 10 * i)
    config = settings(f"{workdir}/store")
    run = lambda count, mode="max": sorted((r.archive_id, r.n) for r in ingest.ingest_next(spark, f"{workdir}/tars", config, count, mode).collect())
    assert run(1) == [(0, 4)]
    assert run(3) == [(1, 4), (3, 4)]
    assert run(3) == []
    fx.archive(f"{workdir}/tars/00002.tar", 20)
    assert run(3) == []
    assert run(3, "gaps") == [(2, 4)]
    manifest = shards.stored_manifest(spark, config.root)
    assert {r.dataset for r in manifest.collect()} == {f"set_{i:05d}" for i in range(4)}
    assert {r.caption for r in manifest.filter("dataset = 'set_00001'").collect()} == {"caption 0 é", "caption 3 é", "caption 4 é", "caption 5 é"}


def test_ingest_next_passes_holes_and_shared_numbers(spark, workdir):
    for name in ("00042", "00100", "other/00100"):
        fx.archive(f"{workdir}/tars/{name}.tar", 10)
    config = settings(f"{workdir}/store")
    run = lambda mode: [(r.archive_id, r.n) for r in ingest.ingest_next(spark, f"{workdir}/tars", config, 1, mode).collect()]
    assert run("max") == [(42, 4)]
    assert run("gaps") == [(100, 8)]
    assert run("max") == run("gaps") == []


def test_archive_stream(spark, workdir):
    config, check, done = settings(f"{workdir}/store"), f"{workdir}/check", f"{workdir}/done"
    for i in range(2):
        fx.archive(f"{workdir}/tars/{i:05d}.tar", 10 * i)
    ingest_archive_stream(spark, f"{workdir}/tars", config, check, done=done)
    assert shards.read_shards(spark, config.root).count() == 8
    ingest_archive_stream(spark, f"{workdir}/tars", config, check, done=done)
    assert shards.read_shards(spark, config.root).count() == 8
    fx.archive(f"{workdir}/tars/00002.tar", 20)
    ingest_archive_stream(spark, f"{workdir}/tars", config, check, done=done)
    assert shards.read_shards(spark, config.root).count() == 12
    assert sorted(r.archive_id for r in spark.read.parquet(done).collect()) == [0, 1, 2]
    # A fresh stream checkpoint sees all archives again and still adds nothing.
    ingest_archive_stream(spark, f"{workdir}/tars", config, f"{workdir}/check2")
    assert shards.read_shards(spark, config.root).count() == 12 == shards.stored_manifest(spark, config.root).count()


# --- the shard store ------------------------------------------------------------------------------


def encoded(spark, rows):
    """``dataset, path, value`` as encoded samples."""
    frame = spark.createDataFrame(rows, "dataset string, path string, value double")
    return frame.select(
        "path", F.lit("c").alias("caption"), F.array(F.col("value").cast("float")).alias("latent"), F.array(F.lit(1)).alias("shape"),
        F.lit(16).alias("image_size"), F.lit("e").alias("encoder_id"), F.lit(None).cast("double").alias("latent_scale"), "dataset",
    )


@pytest.mark.parametrize("precision", ["fp32", "fp16"])
def test_equal_rows_are_samples_of_their_own(spark, workdir, precision):
    root = f"{workdir}/store"
    rows = [("x", "p", float(i % 3)) for i in range(12)] + [("y", "q", 7.5)]
    shards.write_shards(encoded(spark, rows).repartition(4), root, size=5, precision=precision)
    got = shards.read_shards(spark, root)
    assert sorted((r.dataset, r.shard, r["index"]) for r in got.collect()) == [("x", i // 5, i % 5) for i in range(12)] + [("y", 0, 0)]
    assert sorted(r.latent[0] for r in got.collect()) == sorted(v for _, _, v in rows)
    assert {r.latent_scale for r in got.collect()} == {0.18215}
    shards.append_manifest(shards.unlisted_samples(spark, root), root)
    assert shards.unlisted_samples(spark, root).count() == 0
    both = shards.positional_lookup(shards.stored_manifest(spark, root), got).collect()
    assert len(both) == 13 and all(r.caption == "c" and r.latent for r in both)


def test_a_stopped_run_leaves_nothing(spark, workdir):
    root = f"{workdir}/store"
    with pytest.raises(ValueError, match="no shards"):
        shards.read_shards(spark, root)
    assert shards.stored_samples(spark, root).count() == 0
    shards.write_shards(encoded(spark, [("x", f"{i}", 1.0) for i in range(7)]), root, size=5, commit=False)
    assert shards.stored_samples(spark, root).count() == 0 == shards.next_shard_numbers(spark, root).count()
    first = shards.write_shards(encoded(spark, [("x", f"{i}", 1.0) for i in range(7)]), root, size=5)
    shards.write_shards(encoded(spark, [("x", f"{i}", 2.0) for i in range(3)] + [("y", "a", 3.0)]), root, size=5, precision="fp16")
    assert sorted((r.dataset, r.shard, r["index"], r.latent[0]) for r in shards.read_shards(spark, root).collect()) == [
        *[("x", i // 5, i % 5, 1.0) for i in range(7)], *[("x", 2, i, 2.0) for i in range(3)], ("y", 0, 0, 3.0),
    ]
    assert shards.read_shards(spark, root, ["y"]).count() == 1
    assert sorted((r.dataset, r.first, r.next) for r in shards.committed(spark, root).filter(F.col("run") == first).collect()) == [("x", 0, 2)]


def test_build_with_repeated_paths_and_half_precision(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/store"
    pairs = png_pairs(spark, raw, 3)
    twice = pairs.union(pairs.withColumn("caption", F.concat("caption", F.lit(" again"))))
    assert tuple(build(spark, twice, raw, root, precision="fp16")) == (6, 0)
    got = shards.read_shards(spark, root).collect()
    assert len({(r.shard, r["index"]) for r in got}) == 6 and len({r.caption for r in got}) == 6
    assert all(len(r.latent) == 12 for r in got)
    assert tuple(build(spark, twice, raw, root, resuming=True)) == (0, 0)


def test_any_error_of_a_decoder_fails_one_image(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/store"
    pairs = png_pairs(spark, raw, 3)

    def decoder(content):
        if content == fx.png(16, 16, 1):
            raise RuntimeError("codec")
        return fx.read_png(content)

    assert tuple(build(spark, pairs, raw, root, decoder=decoder)) == (2, 1)
    with pytest.raises(Exception, match="Pillow"):
        build(spark, pairs, raw, f"{workdir}/other", decoder=models.decode_rgb)


def dense_resize(square, size):
    """Every output from all inputs, in doubles."""
    side = len(square)
    ratio = side / size
    stretch = max(ratio, 1.0)
    x = np.abs((np.arange(side)[None, :] + 0.5 - ((np.arange(size) + 0.5) * ratio)[:, None]) / stretch)
    w = np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0.0))
    w /= w.sum(axis=1, keepdims=True)
    return np.clip(np.einsum("oi,ijc,pj->opc", w, square.astype(float), w, optimize=True), 0, 255)


@pytest.mark.parametrize(("side", "size"), [(300, 256), (37, 8), (8, 37), (600, 7), (257, 256)])
def test_resize_equals_dense_weights(side, size):
    image = np.random.default_rng(side).integers(0, 256, (side, side, 3), dtype=np.uint8)
    assert np.abs(models.crop_and_resize(image, size) - dense_resize(image, size)).max() <= 0.51


def test_resize_of_a_large_image_in_bounded_memory():
    import tracemalloc

    image = np.random.default_rng(0).integers(0, 256, (4000, 4000, 3), dtype=np.uint8)
    tracemalloc.start()
    out = models.crop_and_resize(image, 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.shape == (256, 256, 3) and peak < 100e6


# --- image heads ----------------------------------------------------------------------------------


def heads(width, height):
    """One file head of each type and its cut forms are judged by."""
    import struct
    from zlib import crc32

    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", crc32(kind + data))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", b"x" * 9) + chunk(b"IEND", b"")
    jpeg = b"\xff\xd8\xff\xe0\x00\x06abcd\xff\xff\xc4\x00\x04\x01\x02\xff\xc2" + struct.pack(">HBHHB", 8, 8, height, width, 0) + b"\xff\xda"
    riff = lambda body: b"RIFF" + struct.pack("<I", len(body) + 4) + b"WEBP" + body
    return {
        "a.png": png,
        "a.jpg": jpeg,
        "a.bmp": b"BM" + bytes(12) + struct.pack("<Iii", 40, width, -height),
        "old.bmp": b"BM" + bytes(12) + struct.pack("<IHH", 12, width, height),
        "a.tiff": b"II*\0" + struct.pack("<IHHHIIHHIHH", 8, 2, 256, 4, 1, width, 257, 3, 1, height, 0),
        "b.tiff": b"MM\0*" + struct.pack(">IHHHIIHHIHH", 8, 2, 256, 4, 1, width, 257, 3, 1, height, 0),
        "x.webp": riff(b"VP8X" + struct.pack("<I", 10) + bytes(4) + (width - 1).to_bytes(3, "little") + (height - 1).to_bytes(3, "little")),
        "l.webp": riff(b"VP8L" + struct.pack("<IB", 5, 0x2F) + struct.pack("<I", width - 1 | height - 1 << 14)),
        "v.webp": riff(b"VP8 " + struct.pack("<I", 10) + b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", width, height)),
    }


@pytest.mark.parametrize("name", list(heads(1, 1)))
def test_image_sizes_from_heads(name):
    from corpusmill.functions.headers import BadHeader, image_size

    data = heads(700, 300)[name]
    assert image_size(data) == (700, 300)
    for cut in range(len(data) - 1):
        try:
            assert image_size(data[:cut]) == (700, 300)
        except BadHeader:
            pass
    for other in (b"", b"no image", data[:12] + b"\0" * 60, b"GIF89a" + data):
        with pytest.raises(BadHeader):
            image_size(other)


ODD = ["sp ace.png", "per%20cent.png", "br[1].png", "é.png", "plus+.png", "{a,b}.png", "sub dir/x y.PNG"]


def test_scan_of_odd_names_and_webp_in_one_read(spark, workdir):
    raw = f"{workdir}/raw"
    for i, name in enumerate(ODD):
        fx.write(f"{raw}/{name}", fx.png(300, 300, i))
    fx.write(f"{raw}/copy [2].png", fx.png(300, 300, 0))
    fx.write(f"{raw}/good.webp", heads(400, 300)["x.webp"])
    fx.write(f"{raw}/bad.webp", b"RIFF....WEBP")
    scan = scan_corpus(spark, raw, f"{workdir}/out", dedupe=True)
    assert {r.reason: r.n for r in scan.report.reasons.collect()} == {"corrupt_or_unreadable": 1, "duplicate_sha1": 1}
    listed = sorted(r.path for r in text.read_filelist(spark, f"{workdir}/out/filelist").collect())
    kept = [n for n in ODD if n != "sp ace.png"] + ["copy [2].png", "good.webp"]
    assert listed == sorted(f"{raw}/{n}" for n in kept)
    assert {r.path.split("/raw/")[1] for r in files.read_images(spark, raw).collect()} >= set(ODD)
    plan = files.examine_images(files.read_files(spark, raw), hashing=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan binaryFile") == 1 and "Exchange" not in plan


def test_audit_finds_files_that_do_not_decode(spark, workdir):
    from corpusmill.plans.scan import audit_decode

    raw = f"{workdir}/raw"
    fx.write(f"{raw}/good [1].png", fx.png(300, 300, 1))
    fx.write(f"{raw}/no pixels.png", heads(300, 300)["a.png"])
    kept = files.read_files(spark, raw).select("path")
    assert [r.path.rsplit("/", 1)[1] for r in audit_decode(spark, kept, 100, 1).collect()] == ["no pixels.png"]
    assert audit_decode(spark, kept.limit(0), 100, 1).count() == 0
    with pytest.raises(ValueError, match="audit failed"):
        scan_corpus(spark, raw, f"{workdir}/out")


def test_hash_failures_are_their_own_reason(spark):
    from corpusmill.plans.scan import judge_images

    rows = spark.createDataFrame(
        [("a", (True, "ok", 300, 300), "s"), ("b", (True, "ok", 300, 300), None), ("c", (True, "ok", 300, 300), "s"), ("d", (True, "ok", 3, 3), None)],
        "path string, verdict struct<ok: boolean, reason: string, width: int, height: int>, sha1 string",
    )
    got = {r.path: r.reason for r in judge_images(rows, hashed=True).collect()}
    assert got == {"a": None, "b": "hash_fail", "c": "duplicate_sha1", "d": "too_small"}
    nothing = spark.createDataFrame([("n", None)], "path string, content binary")
    assert not files.examine_images(nothing, hashing=True).head().verdict.ok

"""Scan a corpus: validate, filter, dedupe, count reasons, list what is kept, audit a sample."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths, rules
from corpusmill.operators import curation, sampling
from corpusmill.sources import files as src
from corpusmill.sources import text as tx


ARROW_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
FILES_PER_BATCH = 64  # whole files that a task holds at a time
AUDIT_FILES = 1000


@dataclass
class ScanReport:
    """``reasons`` (reason, n), ``summary`` (candidates, valid, rejected) and ``valid`` (the kept keys)."""

    reasons: DataFrame
    summary: DataFrame
    valid: DataFrame


def scan_report(
    candidates: DataFrame,
    checks: Sequence[rules.Rule],
    key: str,
    content: Column | None = None,
    include_ok: bool = False,
) -> ScanReport:
    """The funnel over candidates that carry their sizes and, for dedupe, their content."""
    if content is None:
        judged = curation.judge(candidates, checks, key)
        return ScanReport(
            curation.reason_counts(judged, key, include_ok),
            curation.funnel_summary(judged),
            curation.keep_valid(judged).select(key),
        )
    groups = curation.judged_groups(candidates, checks, key, content)
    return ScanReport(
        curation.group_reason_counts(groups, include_ok),
        curation.group_summary(groups),
        curation.kept_of_groups(groups, key),
    )


def judge_images(
    images: DataFrame, min_side: int = rules.MIN_SIDE, min_aspect: float = rules.MIN_ASPECT, max_aspect: float = rules.MAX_ASPECT, hashed: bool = False
) -> DataFrame:
    """``path, reason`` of images with a verdict (``path, verdict``).

    With ``hashed``, ``sha1`` holds the hash of each file within the limits: exact duplicates are rejected too, and a file without a hash is
    ``hash_fail``.
    """
    width, height = F.col("verdict.width"), F.col("verdict.height")
    checks = [
        (rules.CORRUPT, ~F.col("verdict.ok")),
        (rules.TOO_SMALL, rules.too_small(width, height, min_side)),
        (rules.BAD_ASPECT, ~rules.within_aspect(width, height, min_aspect, max_aspect)),
    ]
    first = F.when(~F.col("verdict.ok"), F.col("verdict.reason")).otherwise(rules.first_reject_reason(checks))
    if not hashed:
        return images.select("path", first.alias("reason"))
    judged = images.select("path", F.coalesce(first, F.when(F.col("sha1").isNull(), F.lit(rules.HASH_FAIL))).alias("reason"), "sha1")
    passing = judged.withColumn("sha1", F.when(F.col("reason").isNull(), F.col("sha1")))
    kept = curation.keepers(passing, "sha1", "path").select(F.col("kept").alias("path"), F.lit(True).alias("_kept"))
    duplicate = F.when(F.col("reason").isNull() & F.col("_kept").isNull(), F.lit(rules.DUPLICATE))
    return judged.join(kept, "path", "left").select("path", F.coalesce("reason", duplicate).alias("reason"))


def plain_path(path: Column) -> Column:
    """``file:///a`` and ``file:/a`` both as ``/a``; other schemes are kept."""
    return F.regexp_replace(path, "^file:/+", "/")


@dataclass
class CorpusScan:
    judged: DataFrame
    report: ScanReport
    listed: DataFrame


def scan_corpus(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    min_side: int = rules.MIN_SIDE,
    min_aspect: float = rules.MIN_ASPECT,
    max_aspect: float = rules.MAX_ASPECT,
    dedupe: bool = False,
    store: bool = False,
    audit: int = sampling.AUDIT_SIZE,
    seed: int = sampling.AUDIT_SEED,
    strict: bool = True,
) -> CorpusScan:
    """Scan a folder of images and write ``out_dir/filelist``.

    The files are read once: sizes from their headers and, with ``dedupe``, hashes of those within the limits come out of the same pass,
    as narrow rows that are kept, of no more files at a time than the driver can list. ``store`` lists the paths the files get under
    ``out_dir/images``; moving the bytes is left to the storage's own tools. A seeded sample of ``audit`` kept files is decoded in full.
    """
    from corpusmill.session import shared_folder

    shared_folder(spark)
    limits = (min_side, min_aspect, max_aspect)
    batch = spark.conf.get(ARROW_BATCH)
    spark.conf.set(ARROW_BATCH, str(FILES_PER_BATCH))
    try:
        images = src.read_in_rounds(spark, src.read_files, raw_dir, lambda files: src.examine_images(files, *limits, hashing=dedupe))
    finally:
        spark.conf.set(ARROW_BATCH, batch)
    judged = judge_images(images, *limits, hashed=dedupe)
    kept = curation.keep_valid(judged)
    if strict and kept.isEmpty():
        raise ValueError(f"no valid images below {raw_dir}: check the data or relax the filters")
    listed = kept.select(
        paths.stored_path(plain_path(F.col("path")), plain_root(raw_dir), out_dir, store).alias("path")
    )
    tx.write_filelist(listed, f"{out_dir.rstrip('/')}/filelist")
    failures = audit_decode(spark, kept, audit, seed)
    if strict and not failures.isEmpty():
        raise ValueError(f"audit failed on {failures.head()['path']}")
    report = ScanReport(
        curation.reason_counts(judged, "path"), curation.funnel_summary(judged), kept.select("path")
    )
    return CorpusScan(judged, report, listed)


def plain_root(root: str) -> str:
    return "/" + root[len("file:"):].lstrip("/") if root.startswith("file:") else root


def audit_decode(spark: SparkSession, kept: DataFrame, n: int, seed: int) -> DataFrame:
    """Decode a seeded sample of kept files again in full; returns ``path`` of the failures.

    The JVM's codecs decode; types they lack (WebP) have their headers read again. Only the sampled files are opened, ``AUDIT_FILES`` in one read.
    """
    sample = sampling.sample_n(kept.select("path"), n, ["path"], seed).checkpoint()
    files = [row["path"] for row in sample.orderBy("path").collect()]  # n names
    empty = spark.createDataFrame([], "path string, ok boolean")
    decoded = empty
    for at in range(0, len(files), AUDIT_FILES):
        part = [src.glob_escaped(f) for f in files[at : at + AUDIT_FILES]]
        webp = [f for f in part if f.lower().endswith(".webp")]
        others = [f for f in part if not f.lower().endswith(".webp")]
        if others:
            images = spark.read.format("image").load(others)
            found = rules.verdict(F.col("image.width"), F.col("image.height"))
            decoded = decoded.union(images.select(src.unescaped(F.col("image.origin")).alias("path"), found["ok"]))
        if webp:
            again = src.examine_images(spark.read.format("binaryFile").load(webp))
            decoded = decoded.union(again.select("path", "verdict.ok"))
    plain = decoded.select(plain_path(F.col("path")).alias("path"), "ok")
    return (
        sample.select(plain_path(F.col("path")).alias("path"))
        .join(plain, "path", "left")
        .filter(~F.coalesce("ok", F.lit(False)))
        .select("path")
    )

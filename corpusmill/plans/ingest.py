"""Ingest the next archives: expand, validate, pair, encode, shard."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths, rules
from corpusmill.functions.text import valid_text
from corpusmill.operators import curation, models, pairing, resume
from corpusmill.plans.scan import judge_images
from corpusmill.plans.shards import build_shards
from corpusmill.session import shared_folder
from corpusmill.sources import archives as tar
from corpusmill.sources import shards as store
from corpusmill.sources import text as tx

# Archives per run, and the batch and shard size of a production run.
COUNT = 10
BATCH_SIZE = 128
SHARD_SIZE = 5000


@dataclass
class IngestSettings:
    """What an ingest needs besides its archives."""

    root: str
    encoder: Callable[[], models.Model]
    decoder: Callable = models.decode_rgb
    prefix: str = "set_"
    image_size: int = models.IMAGE_SIZE
    batch_size: int = BATCH_SIZE
    shard_size: int = SHARD_SIZE
    limits: dict = field(default_factory=dict)
    """``min_side``, ``min_aspect``, ``max_aspect`` where they differ from the defaults."""


def ingest_archives(archives: DataFrame, settings: IngestSettings) -> DataFrame:
    """Ingest the given archives (``archive``, and ``length`` if known); each becomes the dataset ``<prefix><id>``, or ``<prefix><name>`` if it has no number.

    Members are handled as index rows (name, offset, size). Image bytes are read once to validate and,
    for the pairs that stay, once to encode; they are never shuffled. Running it again adds nothing.
    Returns ``reason, n`` of the images, kept ones as ``ok``.
    """
    shared_folder(archives.sparkSession)
    members = tar.index_archives(archives).checkpoint()
    pictures = members.filter(F.col("ext").isin(list(paths.IMAGE_EXTENSIONS)))
    probed = models.probe_images(tar.read_members(pictures), settings.decoder)
    judged = judge_images(probed.select("path", "verdict"), **settings.limits).checkpoint()
    kept = pictures.join(curation.keep_valid(judged), "path")
    sidecars = tar.read_members(members.filter(F.col("ext") == ".txt"))
    pairs = pairing.pair_by_stem(
        kept, sidecars, valid_text(F.col("content")), keep=("archive", "archive_id", "offset", "size")
    ).withColumn("dataset", _dataset(settings, F.col("archive")))
    build_shards(
        pairs,
        tar.read_members,
        settings.root,
        settings.encoder,
        image_size=settings.image_size,
        batch_size=settings.batch_size,
        shard_size=settings.shard_size,
        resuming=True,
        decoder=settings.decoder,
    )
    return curation.reason_counts(judged, "path", include_ok=True)


def _dataset(settings: IngestSettings, archive: Column) -> Column:
    return F.concat(F.lit(settings.prefix), tar.archive_label(archive))


def _dataset_id(settings: IngestSettings) -> Column:
    return paths.number_in(F.col("dataset"), rf"^{re.escape(settings.prefix)}(\d+)$")


def finished_archives(spark: SparkSession, settings: IngestSettings, done: str | None = None) -> DataFrame:
    """``dataset, id`` of the archives that have a manifest, and of those in the table ``done``, which also has those that gave no sample."""
    datasets = store.listed_datasets(spark, settings.root)
    if done:
        datasets = datasets.union(tx.read_done(spark, done).select(_dataset(settings, F.col("archive")))).distinct()
    return datasets.select("dataset", _dataset_id(settings).alias("id"))


def next_archives(listed: DataFrame, finished: DataFrame, settings: IngestSettings, count: int, mode: str) -> DataFrame:
    """Rows of ``listed`` to take next: those of the next ``count`` ids, and if these are fewer, archives without a number by name."""
    found = resume.next_listed(listed, finished.filter(F.col("id").isNotNull()), count, mode).checkpoint()
    left = count - found.select("id").distinct().count()
    if left <= 0:
        return found
    unnamed = listed.filter(F.col("id").isNull()).withColumn("dataset", _dataset(settings, F.col("archive")))
    names = unnamed.select("dataset").distinct().join(finished.select("dataset"), "dataset", "left_anti").orderBy("dataset").limit(left)
    return found.unionByName(unnamed.join(F.broadcast(names), "dataset").drop("dataset"))


def ingest_next(
    spark: SparkSession, archive_dir: str, settings: IngestSettings, count: int = COUNT, mode: str = "max", done: str | None = None
) -> DataFrame:
    """Ingest the next ``count`` archives there are; archives that share an id share its dataset.

    With ``done``, a table of finished archives, those that gave no sample are not taken again. Returns ``dataset, archive_id, n, bytes``
    of what is stored for them: ``n`` from the manifest, ``bytes`` from the listing of their files.
    """
    shared_folder(spark)
    listed = tar.list_archives(spark, archive_dir)
    # A few rows: the archives of at most ``count`` ids.
    found = next_archives(listed, finished_archives(spark, settings, done), settings, count, mode).checkpoint()
    if found.isEmpty():
        return spark.createDataFrame([], "dataset string, archive_id bigint, n bigint, bytes bigint")
    ingest_archives(found.select("archive", "length"), settings)
    if done:
        names = found.agg(F.md5(F.array_join(F.array_sort(F.collect_set("archive")), "\n"))).first()[0]
        tx.mark_done(found.select(F.col("id").alias("archive_id"), "archive"), done, names)
    datasets = sorted({row[0] for row in found.select(_dataset(settings, F.col("archive"))).distinct().collect()})
    listed_samples = store.stored_manifest(spark, settings.root, datasets).groupBy("dataset").agg(F.count("*").alias("n"))
    sizes = store.dataset_sizes(spark, settings.root, datasets)
    return listed_samples.join(sizes, "dataset").select("dataset", _dataset_id(settings).alias("archive_id"), "n", "bytes")

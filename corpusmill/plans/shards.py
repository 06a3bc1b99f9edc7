"""Build numbered shards from pairs, and check a manifest against its shards."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import models, resume
from corpusmill.session import scratch_folder
from corpusmill.sources import shards as store

ARROW_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_shards(
    pairs: DataFrame,
    load: Callable[[DataFrame], DataFrame],
    root: str,
    encoder: Callable[[], models.Model],
    order: Sequence[str] = ("path",),
    image_size: int = models.IMAGE_SIZE,
    batch_size: int = models.BATCH_SIZE,
    shard_size: int = store.SHARD_SIZE,
    max_items: int = 0,
    resuming: bool = False,
    encoder_id: str = "encoder",
    decoder: Callable = models.decode_rgb,
    precision: str = "fp32",
) -> DataFrame:
    """Encode pairs into ``root/shards`` and append their records to ``root/manifest``.

    ``pairs`` has ``path, caption, dataset``, and ``ordinal`` when that is the order; ``load`` adds
    the pixels the encoder needs, so payloads are read after the narrow rows have been cut down. With
    ``resuming``, stored paths are left out, after the cut to ``max_items``; samples that a stopped run
    stored but did not list are listed now. The encoder runs once: its output is kept in the shared
    folder, then numbered and written. Pairs may share a path; each is a sample of its own. ``precision`` is that of the stored latents. Returns one row: how many were written and how many failed.
    """
    spark = pairs.sparkSession
    rows = resume.max_items(pairs, max_items, list(order))
    datasets = store.datasets_of(rows)
    if resuming:
        _list_orphans(spark, root, datasets)
        rows = resume.resume_remaining(rows, store.stored_manifest(spark, root, datasets))
    staged = scratch_folder(spark, "encoded")
    batch = spark.conf.get(ARROW_BATCH)
    spark.conf.set(ARROW_BATCH, str(batch_size))
    try:
        encoded = models.encode_batches(
            load(rows), encoder, image_size, batch_size, encoder_id=encoder_id, decoder=decoder
        )
        store.with_row_ids(encoded).write.parquet(staged)
    finally:
        spark.conf.set(ARROW_BATCH, batch)
    stored = spark.read.schema(store.with_row_ids(encoded).schema).parquet(staged)
    good = models.drop_failed_encodes(stored)
    if not good.isEmpty():
        store.write_shards(good, root, order, shard_size, precision)
        _list_orphans(spark, root, datasets)
    return stored.agg(
        F.count_if(F.col("reason").isNull()).alias("written"),
        F.count_if(F.col("reason").isNotNull()).alias("failed"),
    )


def _list_orphans(spark: SparkSession, root: str, datasets: list[str] | None) -> None:
    """Append manifest records for stored samples that have none."""
    orphans = store.unlisted_samples(spark, root, datasets)
    if not orphans.isEmpty():
        store.append_manifest(orphans, root)


def manifest_check(manifest: DataFrame, shards: DataFrame, on: Sequence[str] = ("shard", "index")) -> DataFrame:
    """One row of counts that are all 0 when the two agree.

    ``missing``: samples without a manifest row; ``extra``: manifest rows without a sample;
    ``duplicate_paths``: paths listed more than once; ``broken_shards``: shards whose indexes are not
    0..n-1.
    """
    group = [c for c in on if c != "index"]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = shards.select(*on, one.alias("s"), none.alias("m")).unionByName(
        manifest.select(*on, none.alias("s"), one.alias("m"))
    )
    positions = both.groupBy(*on).agg(F.sum("s").alias("s"), F.sum("m").alias("m"))
    stored = F.col("s") > 0
    at = F.when(stored, F.col("index"))
    per_shard = positions.groupBy(*group).agg(
        F.sum(F.when(F.col("m") == 0, F.col("s")).otherwise(0)).alias("missing"),
        F.count_if(~stored).alias("extra"),
        (
            (F.count_if(stored) > 0)
            & ((F.min(at) != 0) | (F.max(at) != F.count_if(stored) - 1) | (F.max("s") > 1))
        ).alias("broken"),
    )
    repeated = manifest.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*"))
    return per_shard.agg(
        F.coalesce(F.sum("missing"), none).alias("missing"),
        F.coalesce(F.sum("extra"), none).alias("extra"),
        F.count_if("broken").alias("broken_shards"),
    ).select("missing", "extra", repeated.scalar().alias("duplicate_paths"), "broken_shards")

"""Incremental ingest as a stream that stops when nothing is left.

The stream's checkpoint takes the place of a file of finished ids. A batch that is run again after a
failure overwrites its own output, so every input counts once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.plans.ingest import IngestSettings, ingest_archives
from corpusmill.sources.archives import archive_id
from corpusmill.sources.text import mark_done

Process = Callable[[DataFrame], DataFrame]


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "parquet", per_trigger: int = 10, **options: str
) -> DataFrame:
    """A stream of the files matching ``path``, ``per_trigger`` new files per batch."""
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", per_trigger)
    return reader.options(**options).load(path)


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_available(stream: DataFrame, sink: str, checkpoint: str, process: Process | None = None) -> None:
    """Run ``process`` on all that is new and store the result below ``sink``, one folder per batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        out = process(batch) if process else batch
        out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    _run(stream, store, checkpoint)


ARCHIVE_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_archive_stream(
    spark: SparkSession, archive_dir: str, settings: IngestSettings, checkpoint: str, per_trigger: int = 1, done: str | None = None
) -> None:
    """Ingest the archives that have arrived in a folder since the last run.

    Only their paths and lengths go through the stream; contents are read by byte range. Finished archives are stored in the
    table ``done`` when given, one folder per batch of this checkpoint, so a batch that is run again after a failure leaves the same
    rows. The stream's own checkpoint is what counts.
    """
    arrived = file_stream(
        spark, archive_dir, ARCHIVE_FILES, "binaryFile", per_trigger, pathGlobFilter="*.tar"
    ).select(F.col("path").alias("archive"), "length")
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def ingest(batch: DataFrame, batch_id: int) -> None:
        ingest_archives(batch, settings)
        if done:
            mark_done(batch.select(archive_id(F.col("archive")).alias("archive_id"), "archive"), done, f"{run}-{batch_id}")

    _run(arrived, ingest, checkpoint)

"""Exact deduplication of a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedupe_stream(stream: DataFrame, content: Column, within: str | None = None, at: str | None = None) -> DataFrame:
    """Keep the first row of each content by SHA-1.

    All hashes seen are kept as state: copies may be any distance apart. With ``at`` and ``within``
    only copies closer than that are found, and the state is bounded. State is partitioned by hash, and
    a hash that is repeated often is still one entry.
    """
    hashed = stream.withColumn("sha1", F.sha1(content))
    if within and at:
        return hashed.withWatermark(at, within).dropDuplicatesWithinWatermark(["sha1"])
    return hashed.dropDuplicates(["sha1"])


class _FirstOfContent(StatefulProcessor):
    """One entry per hash, which lives for ``ttl_ms`` after it was stored (for ever when None)."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = not self.seen.exists()
        for row in rows:
            if fresh:
                fresh = False
                self.seen.update((True,))
                yield row

    def close(self) -> None:
        pass


def dedupe_stream_after(stream: DataFrame, content: Column, known: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Keep the first row of each content whose SHA-1 is not in ``known`` (a batch table with a column ``sha1``).

    The hashes of a corpus that was deduplicated as a batch become the state of the stream: they are read and shuffled in its
    first micro-batch only, and not joined again with every later one. Whether ``known`` repeats a hash does not matter; its NULLs are
    left out. Rows without content are one content, as in ``dedupe_stream``. With ``ttl_ms`` a hash is forgotten that long after it was
    stored, known ones included, which bounds the state. Start the stream within ``state_in_rocksdb``; a restart from its checkpoint goes on with the stored state.
    """
    hashed = stream.withColumn("sha1", F.sha1(content))
    begin = known.where("sha1 is not null").select("sha1").distinct().groupBy("sha1")
    mode = "None" if ttl_ms is None else "ProcessingTime"
    return hashed.groupBy("sha1").transformWithState(_FirstOfContent(ttl_ms), hashed.schema, "Append", mode, begin)


def seen_contents(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``sha1`` of every content that a stream of ``dedupe_stream_after`` holds as state after its last batch."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "seen").load()
    return state.select("key.sha1")


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, on local disk and not on the heap; it is part of their checkpoint."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)

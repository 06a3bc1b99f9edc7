"""The given tables as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query, r6, sql_r6
from corpusmill.session import scratch_folder
from corpusmill.sources import text as text_src
from corpusmill.streaming import dedupe, ingest, monitor


def _stream(spark, sf_dir, name):
    # A stream source wants a folder or a glob, and reads a single file through one.
    schema = b.table(spark, sf_dir, name).schema
    return ingest.file_stream(spark, f"{sf_dir}/{name}.parque*", schema)


@query("stream_ingest_counts", "SELECT source, count(*) AS rows FROM documents GROUP BY source")
def stream_ingest_counts(spark, sf_dir):
    sink, checkpoint = scratch_folder(spark, "sink"), scratch_folder(spark, "stream")
    ingest.ingest_available(_stream(spark, sf_dir, "documents").select("doc_id", "source"), sink, checkpoint)
    return spark.read.parquet(sink).groupBy("source").agg(F.count("*").alias("rows"))


@query("stream_dedupe", "SELECT count(DISTINCT text) AS hashes FROM documents")
def stream_dedupe(spark, sf_dir):
    sink, checkpoint = scratch_folder(spark, "sink"), scratch_folder(spark, "stream")
    first = dedupe.dedupe_stream(_stream(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"))
    ingest.ingest_available(first.select("doc_id", "sha1"), sink, checkpoint)
    return spark.read.parquet(sink).agg(F.count("*").alias("hashes"))


@query(
    "stream_dedupe_known",
    "SELECT DISTINCT sha1(text) AS sha1 FROM documents WHERE text IS NOT NULL AND text NOT IN (SELECT text FROM documents WHERE lang = 'en' AND text IS NOT NULL)",
)
def stream_dedupe_known(spark, sf_dir):
    """English documents are the corpus that is there; all documents arrive as a stream."""
    sink, checkpoint = scratch_folder(spark, "sink"), scratch_folder(spark, "stream")
    known = b.table(spark, sf_dir, "documents").where("lang = 'en'").select(F.sha1("text").alias("sha1"))
    with dedupe.state_in_rocksdb(spark):
        stream = _stream(spark, sf_dir, "documents").select("text").where("text is not null")
        first = dedupe.dedupe_stream_after(stream, F.col("text"), known).select("sha1")
        ingest.ingest_available(first, sink, checkpoint)
    return spark.read.parquet(sink).select("sha1")


@query(
    "stream_resume_idempotent",
    "SELECT 1 AS run, count(*) AS added FROM documents UNION ALL SELECT 2, 0",
)
def stream_resume_idempotent(spark, sf_dir):
    sink, checkpoint = scratch_folder(spark, "sink"), scratch_folder(spark, "stream")
    totals = []
    for _ in range(2):
        ingest.ingest_available(_stream(spark, sf_dir, "documents").select("doc_id"), sink, checkpoint)
        totals.append(spark.read.parquet(sink).count())
    stored = spark.read.parquet(sink).agg(F.count("*").alias("n"))
    runs = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("run"), F.lit(n).alias("total")) for i, n in enumerate(totals)]))
    before = F.when(F.col("r.run") == 1, F.lit(0)).otherwise(F.lit(totals[0]))
    return stored.select(runs.alias("r")).select("r.run", (F.col("r.total") - before).cast("bigint").alias("added"))


@query(
    "stream_loss",
    b.sql("log", "SELECT step, loss FROM log WHERE step % 10 = 0"),
)
def stream_loss(spark, sf_dir):
    sink, checkpoint = scratch_folder(spark, "sink"), scratch_folder(spark, "stream")
    lines = b.log_lines_of(_stream(spark, sf_dir, "events"))
    ingest.ingest_available(monitor.monitor_loss(text_src.parse_train_log(lines)), sink, checkpoint)
    return spark.read.parquet(sink).select("step", "loss")


@query("stream_smoothed", b.sql("", f"SELECT event_type AS run, event_id AS step, {sql_r6('ema')} AS ema FROM folded", recursive=b.FOLDED))
def stream_smoothed(spark, sf_dir):
    sink, checkpoint = scratch_folder(spark, "sink"), scratch_folder(spark, "stream")
    rows = _stream(spark, sf_dir, "events").select(F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").cast("double").alias("loss"))
    ingest.ingest_available(monitor.smoothed_loss(rows), sink, checkpoint)
    return spark.read.parquet(sink).select("run", "step", r6(F.col("ema")).alias("ema"))

"""Tar archives written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query
from corpusmill.session import scratch_folder
from corpusmill.sources import archives as tar
from corpusmill.sources import text as text_src
from corpusmill.streaming import ingest

_RANGE = 1 << 20  # bytes of an archive that one task indexes
_PER_ARCHIVE = 500


def _packed(spark, sf_dir, folder):
    """One archive for every so many documents, one member per document."""
    rows = b.table(spark, sf_dir, "documents").select(
        F.format_string("%05d", F.floor(F.col("doc_id") / _PER_ARCHIVE).cast("bigint")).alias("label"),
        F.format_string("%09d.txt", "doc_id").alias("member"),
        F.coalesce("text", F.lit("")).alias("content"),
    )
    tar.write_archives(rows, folder)


_MEMBERS = f"""SELECT (doc_id // {_PER_ARCHIVE})::BIGINT AS archive_id, printf('%09d', doc_id) AS key, '.txt' AS ext,
    octet_length(encode(coalesce(text, '')))::BIGINT AS size, sha1(coalesce(text, '')) AS sha1 FROM documents"""


@query("archive_expand", _MEMBERS)
def archive_expand(spark, sf_dir):
    folder = scratch_folder(spark, "tars")
    _packed(spark, sf_dir, folder)
    members = tar.expand_archives(tar.list_archives(spark, folder), _RANGE)
    return members.select("archive_id", "key", "ext", "size", F.sha1("content").alias("sha1"))


@query(
    "archive_stream",
    f"""SELECT (doc_id // {_PER_ARCHIVE})::BIGINT AS archive_id, count(*) AS members, sum(octet_length(encode(coalesce(text, ''))))::BIGINT AS bytes
    FROM documents GROUP BY ALL""",
)
def archive_stream(spark, sf_dir):
    """The archives as a stream that is run twice; the second run finds nothing new."""
    folder, sink, checkpoint, done = (scratch_folder(spark, x) for x in ("tars", "sink", "stream", "done"))
    _packed(spark, sf_dir, folder)

    def indexed(batch):
        found = tar.index_archives(batch, _RANGE)
        text_src.mark_done(found.select("archive_id", "archive"), done, str(batch.select("archive").orderBy("archive").first()[0].rpartition("/")[2]))
        return found.select("archive_id", "member", "size")

    for _ in range(2):
        arrived = ingest.file_stream(spark, folder, ingest.ARCHIVE_FILES, "binaryFile", 50, pathGlobFilter="*.tar")
        ingest.ingest_available(arrived.select(F.col("path").alias("archive"), "length"), sink, checkpoint, indexed)
    totals = spark.read.parquet(sink).groupBy("archive_id").agg(F.count("*").alias("members"), F.sum("size").alias("bytes"))
    return totals.join(text_src.read_done(spark, done).select("archive_id"), "archive_id")

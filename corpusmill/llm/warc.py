"""WARC archives: a writer through Spark's own file committer, and a reader that splits archives.

Each record is a gzip member. Spark's text writer puts members into part files: a member ends with the high byte of its length,
which is 0 below 16 MB, so that byte is the writer's line separator; after a longer record an empty member gives the 0. Files are thus
committed, retried and stored like any other output.

The reader lists the files without opening them and cuts them into byte ranges. A task seeks to its range and looks for gzip magic;
a candidate counts when it inflates to a WARC header. The task owns the records that start in its range, reads the last one to its end, and
goes on from the end of each. Chance magic inside a record that even inflates to a header is found out afterwards: it starts before the end of
a record that started earlier.

Defined results: a NULL payload is empty; NULL ids are kept as such, and do not count as the largest unless there is no other.
Equal payloads under equal ids are all responses. Empty tables give no archive and no record. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_BYTES = 8 << 20
_READ = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_HEAD_BYTES = 64 << 10
_BATCH_ROWS, _BATCH_BYTES = 512, 4 << 20

DATE = "2000-01-01T00:00:00Z"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out[-1] == 0 else out + zlib.compressobj(6, zlib.DEFLATED, 31).flush()


def _urn(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="/:?#[]@!$&'()*+,;=%~"))
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members, without their last byte, of ``page, url, payload, refers_to, revisit`` rows."""
    for batch in batches:
        out, held = [], 0
        for page, url, payload, refers_to, revisit in zip(*(batch.column(i) for i in range(5))):
            raw = payload.as_py() or b""
            digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
            out.append(_member(_record(page.as_py(), url.as_py(), raw, digest, refers_to.as_py(), revisit.as_py()))[:-1])
            held += len(out[-1])
            if held > _BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["value"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> None:
    """Write a record for each row. Of equal payloads of at least ``least_bytes``, that with the largest id is the response."""
    rows = pages.select(F.col(key).cast("bigint").alias("page"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    # Only payloads that occur twice matter; the largest id of a payload is an aggregate with map-side combine.
    sums = rows.select("page", F.sha1("payload").alias("sum"), F.octet_length("payload").alias("bytes")).where(F.col("bytes") >= least_bytes)
    groups = sums.groupBy("sum", "bytes").agg(F.max("page").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    summed = rows.withColumn("sum", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    joined = summed.join(groups, ["sum", "bytes"], "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page").eqNullSafe(F.col("largest"))
    out = joined.select("page", "url", "payload", F.col("largest").alias("refers_to"), revisit.alias("revisit"))
    members = out.mapInArrow(_packed, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\x00").text(path)


def _open(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


class _Source:
    """Bytes of a file by absolute position, read forward in large steps."""

    def __init__(self, stream, at: int):
        self.stream, self.start, self.data = stream, at, b""
        stream.seek(at)

    def fill(self, upto: int) -> bool:
        """Hold the bytes before ``upto``, if there are so many."""
        while self.start + len(self.data) < upto:
            more = self.stream.read(max(_READ, upto - self.start - len(self.data)))
            if not more:
                return False
            self.data += more
        return True

    def drop(self, before: int) -> None:
        if before - self.start > _READ:
            self.data, self.start = self.data[before - self.start :], before


def _inflated(source: _Source, at: int) -> tuple[bytes, int] | None:
    """The record whose member starts at ``at`` and the position after it; None if none does."""
    unpack = zlib.decompressobj(31)
    out, pos, sure = [], at, False
    while not unpack.eof:
        source.fill(pos + 1)
        part = source.data[pos - source.start : pos - source.start + _HEAD_BYTES]
        if not part:
            return None
        try:
            got = unpack.decompress(part)
        except zlib.error:
            return None
        pos += len(part)
        if got:
            out.append(got)
        if not sure and sum(map(len, out)) >= 5:
            if not b"".join(out).startswith(b"WARC/"):
                return None
            sure = True
    return (b"".join(out), pos - len(unpack.unused_data)) if sure else None


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def _number(urn: str | None) -> int | None:
    found = (urn or "").rstrip(">").rpartition(":")[2]
    return int(found) if found.lstrip("-").isdigit() else None


def _parsed(record: bytes):
    """Type, id, url, bytes and digest of the payload, reference, payload (None for a revisit); None if it is no whole record."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    if not gap or not fields.get("content-length", "").isdigit() or len(rest) < int(fields["content-length"]):
        return None
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    kind = fields.get("warc-type")
    page, url = _number(fields.get("warc-record-id")), fields.get("warc-target-uri")
    if kind == "revisit":
        said = _fields(http).get("content-length", "")
        return kind, page, url, int(said) if said.isdigit() else None, fields.get("warc-payload-digest", "").partition(":")[2], _number(fields.get("warc-refers-to")), None
    return kind, page, url, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), None, payload


_RECORDS = (
    "path string, start bigint, end bigint, record_type string, page bigint, url string, payload_bytes bigint, payload_digest string, refers_to bigint"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def _owned(batches: Iterator[pa.RecordBatch], with_payload: bool, ddl: str) -> Iterator[pa.RecordBatch]:
    """Records that start in the ranges ``path, first, last`` (last exclusive)."""
    kind = pa.schema([(n, _KINDS[t]) for n, t in (x.split() for x in ddl.split(", "))])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    for batch in batches:
        for path, first, last in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows, held = [], 0
            with _open(path) as stream:
                source, at = _Source(stream, first), first
                while at < last:
                    source.fill(at + _READ)
                    found = source.data.find(_MAGIC, at - source.start)
                    if found < 0:
                        at = max(at + 1, source.start + len(source.data) - len(_MAGIC) + 1)
                        if not source.fill(at + len(_MAGIC)):
                            break
                        source.drop(at)
                        continue
                    at = source.start + found
                    if at >= last:
                        break
                    inflated = _inflated(source, at)
                    parsed = inflated and _parsed(inflated[0])
                    if not parsed:
                        at += 1
                        continue
                    rows.append((path, at, inflated[1], *parsed[: 7 if with_payload else 6]))
                    held += len(inflated[0])
                    at = inflated[1]
                    source.drop(at)
                    if len(rows) >= _BATCH_ROWS or with_payload and held > _BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records under ``path``: ``path, start, end, record_type, page, url, payload_bytes, payload_digest, refers_to`` (and ``payload``).

    The archives must lie where ``pyarrow.fs`` can open them (local or mounted folders, HDFS, S3, GCS).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("first"), "length")
    ranges = ranges.select("path", "first", F.least(F.col("first") + range_bytes, "length").alias("last"))
    # Ranges are tiny rows, so their partitions are given by number: one range to a task, up to some for each slot.
    n = max(1, min(ranges.count(), 10_000))
    ddl = _RECORDS + (", payload binary" if with_payload else "")
    records = ranges.repartition(n, "path", "first").mapInArrow(lambda batches: _owned(batches, with_payload, ddl), ddl)
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("_reach", F.max("end").over(earlier)).where("_reach is null or _reach <= start").drop("_reach")

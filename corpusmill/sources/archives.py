"""Tar archives of samples.

A tar has no table of contents, and its members are read in order. Here every archive is cut into byte
ranges, and the ranges of all archives are dealt over tasks: a task looks for the first header in its range,
follows the chain of headers, and owns the members whose header begins inside. So one large
archive is indexed by many tasks, and many small ones share a task. Contents are read afterwards, by byte range.

What looks like a header need not be one: a member may be a tar itself, and a range may begin between a long-name
record and the header it belongs to. So each chain is only a claim. The claims of an archive are stitched in order:
the first range starts at byte 0, and every other must contain the header at which the chain before it
arrives; what it found earlier is dropped. An archive whose claims do not fit is walked again in one piece.
The result is that of reading the archive from its start.
"""

from __future__ import annotations

import io
import math
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import paths
from corpusmill.session import shared_folder
from corpusmill.sources.files import create_file, list_files, open_file

CHUNK_BYTES = 64 << 20
BATCH_BYTES = 16 << 20
_INDEX_ROWS = 10_000
_BLOCK = 512  # fixed value: tar blocks
_SCAN_BYTES = 1 << 20
_BUFFER = 64 << 10

_RANGE_SCHEMA = "archive string, length bigint, begin bigint, end bigint"
# One row per header of a chain, and one (``mark``) per chain with its first header and the byte after it.
_WALK_SCHEMA = (
    "archive string, length bigint, begin bigint, end bigint, chain int, mark boolean, header bigint, after bigint, "
    "member string, regular boolean, offset bigint, size bigint"
)
_WALK_ARROW = pa.schema(
    [
        ("archive", pa.string()), ("length", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("chain", pa.int32()),
        ("mark", pa.bool_()), ("header", pa.int64()), ("after", pa.int64()), ("member", pa.string()), ("regular", pa.bool_()),
        ("offset", pa.int64()), ("size", pa.int64()),
    ]
)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for uri in batch.column(0).to_pylist():
            with open_file(uri) as stream:
                sizes.append(stream.size())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, type=pa.int64())], names=["archive", "length"])


# --- headers --------------------------------------------------------------------------------------


def next_header(stream, start: int, stop: int) -> int | None:
    """Position of the first block from ``start`` on, before ``stop``, that reads as a header."""
    at = start
    while at < stop:
        stream.seek(at)
        data = stream.read(min(_SCAN_BYTES, -(-(stop - at) // _BLOCK) * _BLOCK))
        blocks = np.frombuffer(data, dtype=np.uint8, count=len(data) // _BLOCK * _BLOCK).reshape(-1, _BLOCK)
        if not len(blocks):
            return None
        # A header's checksum field holds octal digits, blanks and NULs only, and not only the latter.
        check = blocks[:, 148:156]
        digit = (check >= 0x30) & (check < 0x38)
        for i in np.flatnonzero((digit | (check == 0x20) | (check == 0)).all(axis=1) & digit.any(axis=1)):
            try:
                tarfile.TarInfo.frombuf(blocks[i].tobytes(), tarfile.ENCODING, "surrogateescape")
            except tarfile.HeaderError:
                continue
            return at + int(i) * _BLOCK
        at += len(blocks) * _BLOCK
    return None


def _chain(stream, start: int, stop: int) -> Iterator[tarfile.TarInfo | int | None]:
    """Members from the header at ``start`` on whose header lies before ``stop``, and at last the position of the next header; None if the file ends too early."""
    stream.seek(start)
    with tarfile.open(fileobj=stream, mode="r:") as tar:
        while True:
            tar.members = []  # the tar keeps every header it has seen; drop them as we go
            try:
                member = tar.firstmember if tar.firstmember is not None else tar.next()
                tar.firstmember = None
            except tarfile.ReadError:
                yield None
                return
            if member is None:
                yield -1
                return
            if member.offset >= stop:
                yield member.offset
                return
            yield member


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for given in batch.to_pylist():
            with open_file(given["archive"]) as raw:
                yield from _walk_range(io.BufferedReader(raw, _BUFFER), given)


def _walk_range(stream, given: dict) -> Iterator[pa.RecordBatch]:
    fixed = (given["archive"], given["length"], given["begin"], given["end"])
    stop = given["end"]
    rows: list[tuple] = []
    at: int | None = 0 if given["begin"] == 0 else next_header(stream, given["begin"], stop)
    chain = 0
    while at is not None and at < stop:
        first, last = at, at
        try:
            for found in _chain(stream, at, stop):
                if isinstance(found, tarfile.TarInfo):
                    last = found.offset
                    rows.append((*fixed, chain, False, found.offset, None, found.name, found.isfile(), found.offset_data, found.size))
                    if len(rows) >= _INDEX_ROWS:
                        yield _batch(rows)
                        rows = []
                    continue
                # A chain that ends inside the range ends its archive, be it this one or one inside a member.
                after = given["length"] if found == -1 else found
                rows.append((*fixed, chain, True, first, after, None, None, None, None))
                at = next_header(stream, last + _BLOCK, stop) if found in (-1, None) else None
        except tarfile.ReadError:
            if first == 0:
                raise
            at = next_header(stream, at + _BLOCK, stop)
            continue
        chain += 1
    if not chain:
        rows.append((*fixed, -1, True, None, None, None, None, None, None))
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _WALK_ARROW)], schema=_WALK_ARROW)


_STITCH_SCHEMA = "archive string, begin bigint, chain int, need bigint, sure boolean, cut boolean"


def stitched(claims: pd.DataFrame) -> pd.DataFrame:
    """For the claims of one archive, the chain to use of each range and the header it must begin with.

    ``sure``: the chain begins there; otherwise that header has yet to be looked up. ``cut``: the file ends too early.
    """
    out, arrives = [], 0
    claims = claims.sort_values(["begin", "chain"])
    for (begin, end), own in claims.groupby(["begin", "end"], sort=True):
        if arrives >= end:
            continue
        fits = own[own["header"].notna() & (own["header"] <= arrives)]
        if not len(fits):
            out.append((own["archive"].iloc[0], begin, -1, arrives, False, False))
            break
        row = fits.iloc[-1]
        cut = pd.isna(row["after"])
        out.append((row["archive"], begin, row["chain"], arrives, row["header"] == arrives, cut))
        arrives = row["length"] if cut else row["after"]
    return pd.DataFrame(out, columns=[c.split()[0] for c in _STITCH_SCHEMA.split(", ")])


# --- listing, index, contents ---------------------------------------------------------------------


def archive_id(path: Column) -> Column:
    """The number an archive is named by."""
    return paths.number_in(paths.basename(path), r"^(\d+)\.tar$")


def archive_label(path: Column) -> Column:
    """The padded number an archive is named by, or else its file name without extension, in plain characters."""
    name = F.regexp_replace(F.regexp_replace(paths.basename(path), r"\.tar$", ""), r"[^A-Za-z0-9._-]", "_")
    number = archive_id(path)
    return F.when(number.isNotNull(), paths.zero_pad(number)).otherwise(name)


def list_archives(spark: SparkSession, root: str) -> DataFrame:
    """``archive`` (path), ``id`` (its number), ``length``."""
    return list_files(spark, root, "*.tar").select(
        F.col("path").alias("archive"), archive_id(F.col("path")).alias("id"), "length"
    )


def byte_ranges(archives: DataFrame, range_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``archive, length, begin, end``, dealt over tasks: one for each ``range_bytes`` of all archives, and no fewer than there are cores (or ranges)."""
    spark = archives.sparkSession
    if "length" not in archives.columns:
        few = archives.select("archive").repartition(spark.sparkContext.defaultParallelism)
        archives = few.mapInArrow(_sizes, "archive string, length bigint")
    count = F.greatest(F.lit(1), F.ceil(F.col("length") / range_bytes)).cast("bigint")
    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("i")
    ranges = archives.select("archive", "length", begin).select(
        "archive", "length", (F.col("i") * range_bytes).alias("begin"), F.least((F.col("i") + 1) * range_bytes, "length").alias("end")
    )
    ranges = ranges.checkpoint()
    total = ranges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("end") - F.col("begin")), F.lit(0)).alias("bytes")).first()
    tasks = max(1, math.ceil(total["bytes"] / range_bytes), min(total["n"], spark.sparkContext.defaultParallelism))
    return ranges.repartition(tasks)


def index_archives(archives: DataFrame, range_bytes: int = CHUNK_BYTES, strict: bool = True) -> DataFrame:
    """Regular members without content: ``archive, member, offset, size, archive_id, key, ext, path``.

    ``archives`` has ``archive``, and ``length`` where it is known; the same archive twice counts once. ``key`` is the member's name without
    extension; ``path`` is ``archive/member``. An archive that ends too early is an error, or with ``strict`` off gives
    the members that are whole. Pax records for a whole archive hold for the range they stand in.
    """
    spark = archives.sparkSession
    shared_folder(spark)
    range_bytes = -(-range_bytes // _BLOCK) * _BLOCK
    archives = archives.dropDuplicates(["archive"])
    walked = byte_ranges(archives, range_bytes).mapInArrow(_walk, _WALK_SCHEMA).checkpoint()
    claims = walked.filter("mark").select("archive", "length", "begin", "end", "chain", "header", "after")
    # One row per chain, so about one per range of an archive.
    plan = claims.groupBy("archive").applyInPandas(stitched, _STITCH_SCHEMA).checkpoint()
    found = walked.filter(~F.col("mark"))
    state = plan.agg(F.count_if(F.col("sure")).alias("sure"), F.count_if(F.col("cut")).alias("cut")).first()
    if state["sure"] < claims.filter("chain >= 0").count():
        found = _corrected(archives, found, plan)
    if strict and state["cut"]:
        raise ValueError(f"archive ends too early: {plan.filter('cut').first()['archive']}")
    whole = F.col("regular") & (F.col("offset") + F.col("size") <= F.col("length"))
    return (
        found.filter(whole).select("archive", "member", "offset", "size")
        .withColumn("archive_id", archive_id(F.col("archive")))
        .withColumn("key", paths.stem(F.col("member")))
        .withColumn("ext", paths.extension(F.col("member")))
        .withColumn("path", F.concat_ws("/", "archive", "member"))
    )


def _corrected(archives: DataFrame, found: DataFrame, plan: DataFrame) -> DataFrame:
    """Headers of the chains that were chosen, from the one each must begin with; archives that do not fit are walked again as one range."""
    at = ["archive", "begin", "chain"]
    heads = found.select(*at, F.col("header").alias("need"))
    astray = plan.filter(~F.col("sure")).join(heads, [*at, "need"], "left_anti").select("archive").distinct().checkpoint()
    fitting = plan.join(astray, "archive", "left_anti").select(*at, "need")
    kept = found.join(fitting, at).filter(F.col("header") >= F.col("need")).drop("need")
    if astray.isEmpty():
        return kept
    whole = found.select("archive", "length").distinct().join(astray, "archive")
    again = whole.select("archive", "length", F.lit(0).cast("bigint").alias("begin"), F.col("length").alias("end"))
    alone = again.repartition(max(1, astray.count())).mapInArrow(_walk, _WALK_SCHEMA).checkpoint()
    return kept.unionByName(alone.filter(~F.col("mark") & (F.col("chain") == 0)).select(*kept.columns))


def _contents(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pdfs:
        for uri, members in pdf.groupby("archive", sort=False):
            # Cut the rows so that one batch holds a bounded number of bytes (or one larger member).
            parts = (members["size"].cumsum() - members["size"]) // BATCH_BYTES
            with open_file(uri) as stream:
                for _, part in members.groupby(parts, sort=False):
                    yield part.assign(content=[_read(stream, at, n) for at, n in zip(part["offset"], part["size"])])


def _read(stream, offset: int, size: int) -> bytes:
    stream.seek(offset)
    return stream.read(size)


def read_members(members: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Add ``content`` to index rows; other columns stay. Only narrow rows are shuffled.

    The number of tasks follows from the bytes to read (and is no less than a few per core), so that adaptive
    execution does not merge them by the size of the narrow rows.
    """
    spark = members.sparkSession
    schema = T.StructType([*members.schema.fields, T.StructField("content", T.BinaryType())])
    total, count = members.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    tasks = max(2 * spark.sparkContext.defaultParallelism, min(count, math.ceil(total / chunk_bytes)))
    return (
        members.withColumn("_chunk", F.floor(F.col("offset") / chunk_bytes))
        .repartition(tasks, "archive", "_chunk")
        .drop("_chunk")
        .sortWithinPartitions("archive", "offset")
        .mapInPandas(_contents, schema)
    )


def expand_archives(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All members of the archives with their content."""
    return read_members(index_archives(archives, max(chunk_bytes, _BUFFER)).checkpoint(), chunk_bytes)


# --- writing --------------------------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    current, stream, tar, n = None, None, None, 0

    def close() -> pa.RecordBatch:
        tar.close()
        stream.close()
        return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{current}.tar"]), pa.array([n], type=pa.int64())], names=["archive", "members"])

    for batch in batches:
        for label, member, content in zip(*(batch.column(i) for i in range(3))):
            if label.as_py() != current:
                if tar is not None:
                    yield close()
                current, n = label.as_py(), 0
                stream = create_file(f"{folder}/{current}.tar")
                tar = tarfile.open(fileobj=stream, mode="w|")
            data = content.as_py() or b""
            info = tarfile.TarInfo(member.as_py())
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
            n += 1
    if tar is not None:
        yield close()


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``label, member, content`` as one tar per label, members by name; returns ``archive, members``.

    One task writes an archive from start to end, one member in memory at a time, so a label should hold what one archive is to hold. A task that
    runs again writes the same file again.
    """
    shared_folder(rows.sparkSession)
    ordered = rows.select("label", "member", F.col("content").cast("binary")).repartition("label").sortWithinPartitions("label", "member")
    return ordered.mapInArrow(lambda batches: _pack(batches, folder.rstrip("/")), "archive string, members bigint").checkpoint()

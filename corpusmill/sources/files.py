"""File listings and decoded images.

Spark's file sources leave out hidden files (``.x``, ``_x``) and empty files, so those are neither
candidates nor counted as corrupt.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import batched, chain, islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths
from corpusmill.functions.headers import BadHeader, image_size
from corpusmill.functions.rules import MAX_ASPECT, MIN_ASPECT, MIN_SIDE, verdict
from corpusmill.operators.sampling import shuffled
from corpusmill.session import scratch_folder

# Names of saved checkpoints (group 1 is the step), and of the latest one.
CHECKPOINT_NAME = r"unet_step_(\d+)\.pt$"
LATEST_CHECKPOINT = "unet_latest.pt"


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path, length, modified`` of every file below ``root``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def open_file(uri: str):
    """A file by the path Spark lists it under, whose characters are not escaped."""
    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/"))
    scheme, _, rest = uri.partition("://")
    authority, _, path = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system.open_input_file(f"{base.rstrip('/')}/{path}")


def create_file(uri: str):
    """A file to write at a path as Spark would list it, its folder made where folders exist; an earlier file is replaced."""
    if uri.startswith(("/", "file:")):
        path, system = "/" + uri.removeprefix("file:").lstrip("/"), fs.LocalFileSystem()
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path)
    scheme, _, rest = uri.partition("://")
    authority, _, path = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system.open_output_stream(f"{base.rstrip('/')}/{path}")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            with create_file(path) as stream:
                stream.write(content.as_py() or b"")
        yield pa.RecordBatch.from_arrays([batch.column(0)], names=["path"])


def write_files(rows: DataFrame) -> int:
    """Write each ``path, content`` row as a file of its own; returns their number. A task that runs again writes the same files again."""
    return rows.select("path", F.col("content").cast("binary")).mapInArrow(_write, "path string").count()


# What opening a file counts for in bytes when files are dealt to tasks, far below Spark's 4 MB.
OPEN_COST = "spark.sql.files.openCostInBytes"
SMALL_FILE = 16 * 1024
# How Spark looks up the files of a list: in so many tasks, and kept by the driver up to so many bytes.
LOOKUP_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LOOKUP_KEPT = "spark.sql.hive.filesourcePartitionFileCacheSize"


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    kept = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Thousands of small files to a task, for reads that end inside; with Spark's own setting it is 32 at most."""
    with _settings(spark, **{OPEN_COST: str(SMALL_FILE)}):
        yield


# Files that one read lists, some 2 KB of the driver's memory each.
FILES_AT_ONCE = 50_000


def _hidden(name: str) -> bool:
    """Names that Spark's file sources leave out, of files and of folders."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_metadata", "_common_metadata"))


def _local_files(root: str) -> Iterator[str]:
    """Broken links and names that are no text are left out, as by the JVM."""
    folders = [root]
    while folders:
        with os.scandir(folders.pop()) as entries:
            for entry in entries:
                if _hidden(entry.name) or os.fsencode(entry.name).decode(errors="replace") != entry.name:
                    continue
                if entry.is_dir():
                    folders.append(entry.path)
                elif not entry.is_symlink() or os.path.exists(entry.path):
                    yield f"file:{entry.path}"


def walk_files(spark: SparkSession, root: str) -> Iterator[str]:
    """Paths of the files below ``root``, as Spark's file sources find and name them, one after the other: no list of all is held.

    Like theirs, ``root`` may be a pattern. A local folder is read entry by entry, a store in the pages that it lists.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    tops = {found.getPath().toString(): found for found in store.globStatus(path) or ()}
    for top, found in tops.items():
        folders = top.split("/")
        if any("/".join(folders[:i]) in tops for i in range(1, len(folders))):
            continue  # found below the other
        if top.startswith("file:") and found.isDirectory():
            yield from _local_files(top.removeprefix("file:"))
            continue
        above = len(top.rstrip("/") if found.isDirectory() else top.rpartition("/")[0]) + 1
        files = store.listFiles(found.getPath(), True)
        while files.hasNext():
            name = files.next().getPath().toString()
            if not any(_hidden(part) for part in name[above:].split("/")):
                yield name


def _load(reader: DataFrameReader, root: str | list[str]) -> DataFrame:
    """A list of paths, none a pattern, goes to the JVM in one call, not one for each."""
    if isinstance(root, str):
        return reader.load(root)
    jvm = reader._spark._jvm
    each = jvm.java.util.regex.Pattern.compile("\0").splitAsStream("\0".join(map(glob_escaped, root)))
    listed = each.collect(jvm.java.util.stream.Collectors.toList())
    return reader._df(reader._jreader.load(jvm.org.apache.spark.api.python.PythonUtils.toSeq(listed)))


def read_in_rounds(
    spark: SparkSession,
    read: Callable[..., DataFrame],
    root: str,
    narrow: Callable[[DataFrame], DataFrame],
    extensions: Sequence[str] = paths.IMAGE_EXTENSIONS,
) -> DataFrame:
    """What ``narrow`` makes of the files below ``root`` that ``read`` reads (:func:`read_files`, :func:`read_images`), kept in the shared folder.

    The driver holds what Spark lists for a read. So of a folder with more than ``FILES_AT_ONCE`` files that many are listed and read at a time;
    ``narrow`` works on each row by itself.
    """
    walked, endings = walk_files(spark, root), tuple(e.lower() for e in extensions)
    some = list(islice(walked, FILES_AT_ONCE + 1))
    with small_files(spark):
        if len(some) <= FILES_AT_ONCE:
            return narrow(read(spark, root, extensions)).checkpoint()
        candidates = (f for f in chain(some, walked) if f.lower().endswith(endings))
        candidates = chain([next(candidates, some[0])], candidates)  # without any, the reader leaves this one out
        folder, tasks = scratch_folder(spark, "rounds"), 2 * spark.sparkContext.defaultParallelism
        with _settings(spark, **{LOOKUP_TASKS: str(tasks), LOOKUP_KEPT: "0"}):
            for files in batched(candidates, FILES_AT_ONCE):
                narrow(read(spark, list(files), extensions)).write.mode("append").parquet(folder)
                gc.collect()  # Python's handles of JVM objects hold each other, and so the listings of earlier rounds
    return spark.read.parquet(folder)


def scan_files(
    spark: SparkSession, root: str, extensions: Sequence[str] = paths.IMAGE_EXTENSIONS
) -> DataFrame:
    """Candidate files by extension, in any letter case. The listing itself filters by glob."""
    listed = list_files(spark, root, paths.image_glob(extensions))
    return keep_extensions(listed, F.col("path"), extensions)


def keep_extensions(
    df: DataFrame, path: Column, extensions: Sequence[str] = paths.IMAGE_EXTENSIONS
) -> DataFrame:
    return df.withColumn("ext", paths.extension(path)).filter(
        F.col("ext").isin([e.lower() for e in extensions])
    )


def _examined(batches: Iterator[pa.RecordBatch], limits: tuple[int, float, float], hashing: bool) -> Iterator[pa.RecordBatch]:
    min_side, low, high = limits
    for batch in batches:
        sizes, sums = [], []
        for value in batch.column(1):
            data = value.as_py()
            try:
                size = image_size(data or b"")
            except BadHeader:
                size = None
            sizes.append(size)
            passes = size is not None and min(size) >= min_side and low <= size[0] / size[1] <= high
            sums.append(hashlib.sha1(data).hexdigest() if hashing and passes else None)
        width, height = (pa.array([s[i] if s else None for s in sizes], type=pa.int64()) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), width, height, pa.array(sums, type=pa.string())], names=["path", "width", "height", "sha1"])


def examine_images(
    rows: DataFrame, min_side: int = MIN_SIDE, min_aspect: float = MIN_ASPECT, max_aspect: float = MAX_ASPECT, hashing: bool = False
) -> DataFrame:
    """``path, verdict, sha1`` of files given as ``path, content``, in one pass over the bytes.

    Sizes come from the headers (:mod:`corpusmill.functions.headers`). With ``hashing``, files within the limits are hashed while their bytes are at hand; the others
    have no hash. NULL content is corrupt. Only narrow rows leave the task.
    """
    found = rows.select("path", "content").mapInArrow(
        lambda batches: _examined(batches, (min_side, min_aspect, max_aspect), hashing), "path string, width bigint, height bigint, sha1 string"
    )
    return found.select("path", verdict(F.coalesce("width", F.lit(-1)), F.coalesce("height", F.lit(-1))).alias("verdict"), "sha1")


def read_files(spark: SparkSession, root: str | list[str], extensions: Sequence[str] = paths.IMAGE_EXTENSIONS) -> DataFrame:
    """``path, content`` of the candidate files: one scan, names as they are on the storage. ``root`` may be a list of files."""
    files = _load(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", paths.image_glob(extensions)), root)
    return keep_extensions(files.select("path", "content"), F.col("path"), extensions).drop("ext")


def unescaped(path: Column) -> Column:
    """A path that the image source has written as a URI, as it is on the storage."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def glob_escaped(path: str) -> str:
    """A path to be loaded as such, not as a pattern."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def read_images(
    spark: SparkSession, root: str | list[str], extensions: Sequence[str] = paths.IMAGE_EXTENSIONS
) -> DataFrame:
    """Decoded images with their verdict: ``path, verdict, n_channels, data`` (BGR bytes). ``root`` may be a list of files.

    Broken files come back with ``verdict.ok = false``. Decoding is done by the JVM's image codecs;
    a type they lack (WebP) comes out as corrupt.
    """
    reader = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", paths.image_glob(extensions))
    return _load(reader, root).select(
        unescaped(F.col("image.origin")).alias("path"),
        verdict(F.col("image.width"), F.col("image.height")).alias("verdict"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.data").alias("data"),
    )


def list_datasets(files: DataFrame, root: str) -> DataFrame:
    """Immediate sub-folders of ``root`` in a listing, with their number of files."""
    return (
        files.withColumn("dataset", paths.first_folder(F.col("path"), root))
        .filter(F.col("dataset") != "")
        .groupBy("dataset")
        .agg(F.count("*").alias("files"))
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def list_shards(
    files: DataFrame, suffix: str = ".pt", max_shards: int = 0, seed: int = 0, strict: bool = True
) -> DataFrame:
    """Distinct shard paths in seeded random order: ``position, path``; ``max_shards`` 0 means all."""
    found = files.select("path").filter(F.col("path").endswith(suffix)).distinct()
    if strict and found.isEmpty():
        raise ValueError(f"no {suffix} shards found")
    order = shuffled(found, ["path"], seed)
    return order.filter(F.col("position") < max_shards) if max_shards > 0 else order


def list_checkpoints(names: DataFrame, shown: int = 10, pattern: str = CHECKPOINT_NAME) -> DataFrame:
    """The last ``shown`` checkpoints by name, with their step and the number of older ones.

    The step comes from the name, so no checkpoint has to be opened.
    """
    found = names.select(paths.basename(F.col("name")).alias("name")).filter(F.col("name").rlike(pattern)).distinct()
    step = paths.number_in(F.col("name"), pattern)
    older = F.greatest(found.agg(F.count("*")).scalar() - shown, F.lit(0)).cast("bigint")
    return (
        found.orderBy(F.desc("name"))
        .limit(shown)
        .select("name", step.alias("step"), older.alias("older"))
    )


def latest_checkpoint(names: DataFrame, latest: str = LATEST_CHECKPOINT) -> DataFrame:
    """The latest checkpoint, when it is there."""
    return names.select("name").filter(paths.basename(F.col("name")) == latest).distinct()

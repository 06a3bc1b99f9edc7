"""Numbered shards of encoded samples and their manifest.

A shard is a Parquet partition ``run=<id>/dataset=<name>/shard=<number>``; what was constant per shard file
(image size, encoder, scale) are columns, which Parquet stores once per page as a dictionary.

Each write is a *run* of its own folder, and one record per dataset in ``commits`` ends it: the numbers it took and how its latents are
stored. Readers see committed runs only, so a run that was stopped, or a task of it, leaves nothing that counts, and doing it
again writes every shard once. The next free number comes from these records, not from the shards.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.functions import paths
from corpusmill.functions.text import MANIFEST_SCHEMA, manifest_line, parsed_manifest_line
from corpusmill.functions.vectors import LATENT_SCALE
from corpusmill.operators import ordered
from corpusmill.operators.models import cast_precision, unpack_half
from corpusmill.operators.sizing import broadcast_if_small
from corpusmill.session import scratch_folder, shared_folder
from corpusmill.sources.files import list_files, open_file

# Fixed value: samples per shard.
SHARD_SIZE = 2000
# Datasets named in a partition filter.
MAX_PRUNED = 1000
# Bytes of a row group, so that a few drawn rows do not read a whole shard; drawn rows of a task, and of a batch it returns.
GROUP_BYTES = 4 << 20
TASK_DRAWS = 5000
_BATCH_ROWS = 256

HALF = "fp16"
ROW = "_row"
COMMIT_SCHEMA = "run string, dataset string, first bigint, next bigint, precision string"
SHARD_SCHEMA = (
    "index bigint, path string, caption string, latent array<float>, shape array<int>, "
    "image_size int, encoder_id string, latent_scale double, dataset string, shard int"
)
# As stored: latents as FLOAT or as packed half precision.
STORED_SCHEMA = SHARD_SCHEMA.replace("shape array", "latent_half binary, shape array") + ", run string"


def shard_of(ordinal: Column, size: int, start: Column | int = 0) -> Column:
    """Shard number of the n-th sample."""
    first = F.lit(start) if isinstance(start, int) else start
    return first + F.floor(ordinal / size).cast("bigint")


def index_of(ordinal: Column, size: int) -> Column:
    return F.pmod(ordinal, F.lit(size)).cast("bigint")


def with_shards(
    keys: DataFrame,
    order: Sequence[str],
    size: int = SHARD_SIZE,
    start: int = 0,
    by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """:func:`assign_shards` for rows that are narrow already: nothing is joined."""
    numbered = ordered.with_ordinal(keys, order, by, "_at", partitions)
    at = F.col("_at")
    return numbered.withColumn("shard", shard_of(at, size, start)).withColumn("index", index_of(at, size)).drop("_at")


def shard_folder(root: str) -> str:
    return f"{root.rstrip('/')}/shards"


def manifest_folder(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def commit_folder(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def committed(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """``run, dataset, first, next, precision`` of the runs that are done; no rows when nothing is stored yet."""
    try:
        found = spark.read.schema(COMMIT_SCHEMA).json(commit_folder(root))
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return found if datasets is None else found.filter(F.col("dataset").isin(list(datasets)))


def stored_samples(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """All samples of committed runs, latents as FLOAT; a missing scale gets the default one. Datasets prune runs and partitions.

    The runs are named one by one, so that no other folder is listed.
    """
    runs = committed(spark, root, datasets).groupBy("run").agg(F.max(F.col("precision") == HALF).alias("half")).collect()
    if not runs:
        return spark.createDataFrame([], SHARD_SCHEMA)
    folder = shard_folder(root)
    shards = spark.read.schema(STORED_SCHEMA).option("basePath", folder).parquet(*[f"{folder}/run={r['run']}" for r in runs])
    if datasets is not None:
        shards = shards.filter(F.col("dataset").isin(list(datasets)))
    if any(r["half"] for r in runs):
        shards = shards.withColumn("latent", F.coalesce("latent", unpack_half(F.col("latent_half"))))
    return shards.withColumn("latent_scale", default_scale(F.col("latent_scale"))).select(*_names(SHARD_SCHEMA))


def read_shards(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """:func:`stored_samples`, an error when nothing is stored."""
    if committed(spark, root, datasets).isEmpty():
        raise ValueError(f"no shards below {root}")
    return stored_samples(spark, root, datasets)


def datasets_of(rows: DataFrame) -> list[str] | None:
    """The datasets a run touches, to prune what is read back; None (all) when they are too many."""
    names = [r[0] for r in rows.select("dataset").distinct().limit(MAX_PRUNED + 1).collect()]
    return names if len(names) <= MAX_PRUNED else None


def next_shard_numbers(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """``dataset, next``: the first number no committed run has taken."""
    return committed(spark, root, datasets).groupBy("dataset").agg(F.max("next").alias("next"))


def default_scale(scale: Column) -> Column:
    return F.coalesce(scale, F.lit(LATENT_SCALE))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def with_row_ids(encoded: DataFrame) -> DataFrame:
    """A number for each row, to be stored with it: rows may share a path, a caption, everything."""
    return encoded.withColumn(ROW, F.monotonically_increasing_id())


def write_shards(
    encoded: DataFrame, root: str, order: Sequence[str] = ("path",), size: int = SHARD_SIZE, precision: str = "fp32", commit: bool = True
) -> str:
    """Store encoded samples as the shards of a new run, numbered on from the committed ones of their ``dataset``; returns the run.

    Rows are told apart by a stored row number (:func:`with_row_ids`); a table without one is stored with it first. Keys are numbered
    as narrow rows and joined to the payload by that number (broadcast while they are few); rows that are equal in ``order`` go in row order. A shard
    holds at most ``size`` samples, so no task gets more than that of one shard. ``precision`` fp16 keeps latents as packed bytes. Without
    ``commit`` the run stays invisible.
    """
    spark = encoded.sparkSession
    if ROW not in encoded.columns:
        staged = scratch_folder(spark, "rows")
        with_row_ids(encoded).write.parquet(staged)
        encoded = spark.read.parquet(staged)
    run = uuid.uuid4().hex
    keys = encoded.select(*dict.fromkeys([ROW, "dataset", *order]))
    numbered = ordered.with_ordinal(keys, [*order, ROW], ["dataset"], "_at").select(ROW, "dataset", "_at")
    starts = broadcast_if_small(next_shard_numbers(spark, root, datasets_of(keys)))
    first, at = F.coalesce("next", F.lit(0).cast("bigint")), F.col("_at")
    placed = numbered.join(starts, "dataset", "left").select(
        ROW, "dataset", shard_of(at, size, first).cast("int").alias("shard"), index_of(at, size).alias("index")
    ).checkpoint()
    half = cast_precision(F.col("latent"), HALF) if precision == HALF else F.lit(None).cast("binary")
    latent = F.lit(None).cast("array<float>") if precision == HALF else cast_precision(F.col("latent"), precision)
    (
        encoded.join(broadcast_if_small(placed.drop("dataset")), ROW)
        .withColumns({"run": F.lit(run), "latent_half": half, "latent": latent})
        .select(*_names(STORED_SCHEMA))
        .repartition("dataset", "shard")
        .sortWithinPartitions("dataset", "shard", "index")
        .write.mode("append")
        .option("parquet.block.size", GROUP_BYTES)
        .partitionBy("run", "dataset", "shard")
        .parquet(shard_folder(root))
    )
    if commit:
        taken = placed.groupBy("dataset").agg(F.min("shard").cast("bigint").alias("first"), (F.max("shard") + 1).cast("bigint").alias("next"))
        record = taken.select(F.lit(run).alias("run"), "dataset", "first", "next", F.lit(precision).alias("precision"))
        record.coalesce(1).write.mode("append").json(commit_folder(root))
    return run


def manifest_of(shards: DataFrame) -> DataFrame:
    """Manifest rows ``shard, index, path, caption`` from stored shards, so the two cannot disagree."""
    kept = [c for c in ("dataset",) if c in shards.columns]
    return shards.select(*kept, paths.shard_name(F.col("shard")).alias("shard"), "index", "path", "caption")


def manifest_lines(rows: DataFrame) -> DataFrame:
    kept = [c for c in ("dataset",) if c in rows.columns]
    line = manifest_line(F.col("shard"), F.col("index"), F.col("path"), F.col("caption"))
    return rows.select(*kept, line.alias("value"))


def append_manifest(shards: DataFrame, root: str) -> None:
    """Append the manifest records of the given stored shards as JSON lines, a folder per dataset."""
    lines = manifest_lines(manifest_of(shards))
    lines.write.mode("append").partitionBy("dataset").text(manifest_folder(root))


def stored_manifest(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """``dataset`` and the manifest's columns; no rows when nothing is stored yet."""
    try:
        lines = spark.read.schema("value string, dataset string").text(manifest_folder(root))
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], f"dataset string, {MANIFEST_SCHEMA}")
    if datasets is not None:
        lines = lines.filter(F.col("dataset").isin(list(datasets)))
    records = lines.select("dataset", parsed_manifest_line(F.col("value")).alias("rec"))
    return records.select("dataset", "rec.*").filter(F.col("path").isNotNull())


def listed_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Datasets that have a manifest, from the file listing alone."""
    try:
        files = list_files(spark, manifest_folder(root))
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], "dataset string")
    return files.select(F.regexp_extract("path", "/dataset=([^/]+)/", 1).alias("dataset")).distinct()


def dataset_sizes(spark: SparkSession, root: str, datasets: Sequence[str]) -> DataFrame:
    """``dataset, bytes``: file sizes of the committed shards of the given datasets, from their listing alone."""
    runs = committed(spark, root, datasets).select("run", "dataset").distinct().collect()
    if not runs:
        return spark.createDataFrame([], "dataset string, bytes bigint")
    folder = shard_folder(root)
    files = spark.read.format("binaryFile").option("basePath", folder).load([f"{folder}/run={r['run']}/dataset={r['dataset']}" for r in runs])
    return files.groupBy("dataset").agg(F.sum("length").alias("bytes"))


def unlisted_samples(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """Stored samples at whose place no manifest record stands (a run stopped between the two writes)."""
    place = ["dataset", "_name", "index"]
    listed = stored_manifest(spark, root, datasets).select("dataset", F.col("shard").alias("_name"), "index")
    stored = stored_samples(spark, root, datasets).select("dataset", "shard", "index", "path", "caption")
    return stored.withColumn("_name", paths.shard_name(F.col("shard"))).join(listed, place, "left_anti").drop("_name")


def positional_lookup(manifest: DataFrame, shards: DataFrame, on: Sequence[str] = ("dataset", "shard", "index")) -> DataFrame:
    """Manifest rows with the payload at their position; shards are named as in the manifest. Rows of either side without the other are left out."""
    named = shards.drop("path", "caption").withColumn("shard", paths.shard_name(F.col("shard")))
    return named.join(manifest, list(on))


# --- drawn rows -----------------------------------------------------------------------------------

_PAYLOAD = {"path": "string", "caption": "string", "latent": "array<float>", "shape": "array<int>", "latent_scale": "double"}


def stored_files(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """``dataset, shard, file`` of the committed shards, from the listing alone."""
    runs = [r["run"] for r in committed(spark, root, datasets).select("run").distinct().collect()]
    if not runs:
        return spark.createDataFrame([], "dataset string, shard int, file string")
    folder = shard_folder(root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f"{folder}/run={r}" for r in runs])
    part = lambda name, text: F.regexp_extract("path", f"/{name}=({text})/", 1)
    found = files.filter(F.col("path").endswith(".parquet")).select(part("dataset", "[^/]+").alias("dataset"), part("shard", r"\d+").cast("int").alias("shard"), F.col("path").alias("file"))
    return found if datasets is None else found.filter(F.col("dataset").isin(list(datasets)))


def groups_of(metadata: pq.FileMetaData, indices: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Row groups that hold any of the sorted ``indices`` by their statistics, each with the positions of those it may hold."""
    column = metadata.schema.names.index("index")
    out = []
    for g in range(metadata.num_row_groups):
        stats = metadata.row_group(g).column(column).statistics
        low, high = (stats.min, stats.max) if stats is not None and stats.has_min_max else (-(1 << 63), (1 << 63) - 1)
        a, b = np.searchsorted(indices, low, side="left"), np.searchsorted(indices, high, side="right")
        if a < b:
            out.append((g, np.arange(a, b)))
    return out


def _floats(latent: pa.Array, half: pa.Array) -> pa.Array:
    """Latents as FLOAT, from packed halves where they are kept so."""
    if latent.null_count == 0:
        return latent
    rows = [a if a is not None else None if h is None else np.frombuffer(h, dtype="<f2").astype(np.float32) for a, h in zip(latent.to_pylist(), half.to_pylist())]
    return pa.array(rows, type=pa.list_(pa.float32()))


def _drawn(batches: Iterator[pa.RecordBatch], columns: Sequence[str], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Payload of drawn rows, which come in order of ``_file`` and ``index``."""
    for batch in batches:
        files = batch.column("_file").to_pylist()
        edges = [0, *[i for i in range(1, len(files)) if files[i] != files[i - 1]], len(files)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            indices = part.column("index").to_numpy()
            with open_file(files[a]) as stream:
                shard = pq.ParquetFile(stream)
                for group, at in groups_of(shard.metadata, indices):
                    wanted = ["index", *columns, *(["latent_half"] if "latent" in columns else [])]
                    table = shard.read_row_group(group, columns=wanted).combine_chunks()
                    places = {int(x): i for i, x in enumerate(table.column("index").to_pylist())}
                    hits = [(int(i), places[int(indices[i])]) for i in at if int(indices[i]) in places]
                    for k in range(0, len(hits), _BATCH_ROWS):
                        yield _joined(part, table, hits[k : k + _BATCH_ROWS], columns, kind)


def _joined(draws: pa.RecordBatch, table: pa.Table, hits: Sequence[tuple[int, int]], columns: Sequence[str], kind: pa.Schema) -> pa.RecordBatch:
    rows, places = (pa.array(x, type=pa.int64()) for x in zip(*hits))
    left = draws.take(rows)
    right = table.take(places).combine_chunks()
    chunk = lambda name: right.column(name).chunk(0)
    payload = [_floats(chunk("latent"), chunk("latent_half")) if c == "latent" else chunk(c) for c in columns]
    arrays = [left.column(n) for n in kind.names if n not in columns]
    return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip([*arrays, *payload], kind)], schema=kind)


def gather_stored(draws: DataFrame, root: str, columns: Sequence[str] = tuple(_PAYLOAD)) -> DataFrame:
    """``draws`` (``dataset, shard, index, ...``) with the payload of the stored samples they name, with repetition.

    The draws go to the shards, not the shards to the draws: only narrow rows are shuffled, to tasks of about ``TASK_DRAWS`` draws of the
    same files, and a task reads the row groups that hold its indices, of the asked columns. Shards that nothing was drawn from are not
    opened. A shard of many draws is shared by several tasks.
    """
    spark = draws.sparkSession
    shared_folder(spark)
    placed = draws.join(stored_files(spark, root), ["dataset", "shard"]).withColumnRenamed("file", "_file").checkpoint()
    counts = placed.groupBy("_file").agg(F.count("*").alias("_n")).select("_file", F.ceil(F.col("_n") / TASK_DRAWS).cast("int").alias("_parts"))
    total = placed.count()
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / TASK_DRAWS))
    keyed = placed.join(broadcast_if_small(counts), "_file").withColumn("_part", F.pmod(F.xxhash64(*draws.columns), F.col("_parts")))
    dealt = keyed.repartition(tasks, "_file", "_part").sortWithinPartitions("_file", "index").select(*draws.columns, "_file")
    fields = [*draws.schema.fields, *[T.StructField(c, T._parse_datatype_string(_PAYLOAD[c])) for c in columns]]
    schema = T.StructType(fields)
    kind = to_arrow_schema(schema)
    return dealt.mapInArrow(lambda batches: _drawn(batches, list(columns), kind), schema)

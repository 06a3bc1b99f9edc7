"""Text sources: pairs, path lists, manifests, training logs, loss tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import ordered

LOSS_SCHEMA = "step bigint, loss double"
_LINE_ORDER = ["_file", "_block", "_row"]
# Further characters that end a line when text is split into lines.
_LINE_BREAKS = r"[\n-\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def read_lines(spark: SparkSession, path: str, ordinal: bool = False) -> DataFrame:
    """Lines as ``value``; with ``ordinal`` also their position over all files of ``path``.

    Files are split over tasks, so the position is taken from file, block and row within the block.
    """
    lines = spark.read.text(path)
    if not ordinal:
        return lines
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return ordered.with_ordinal(placed, _LINE_ORDER).drop(*_LINE_ORDER)


def split_pairs(lines: DataFrame) -> DataFrame:
    """``path, caption, ok``: split at the first tab; a line without a tab is not ok."""
    parts = F.split(F.col("value"), "\t", 2)
    rest = [c for c in lines.columns if c != "value"]
    return lines.filter(F.col("value") != "").select(
        *rest,
        "value",
        parts[0].alias("path"),
        F.get(parts, F.lit(1)).alias("caption"),
        (F.size(parts) == 2).alias("ok"),
    )


def parse_pairs(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """Pairs from lines. ``failfast`` raises on a line without a tab, ``permissive`` leaves it out
    (see :func:`pair_rejects`)."""
    split = split_pairs(lines)
    if mode == "permissive":
        return split.filter("ok").drop("ok", "value")
    if mode != "failfast":
        raise ValueError("mode must be failfast or permissive")
    message = F.concat(F.lit("pair line without a tab: "), F.col("value"))
    return split.withColumn(
        "caption", F.when(F.col("ok"), F.col("caption")).otherwise(F.raise_error(message).cast("string"))
    ).drop("ok", "value")


def pair_rejects(lines: DataFrame) -> DataFrame:
    return split_pairs(lines).filter("NOT ok").select("value")


def read_pairs(spark: SparkSession, path: str, mode: str = "failfast", ordinal: bool = False) -> DataFrame:
    return parse_pairs(read_lines(spark, path, ordinal), mode)


def parse_filelist(lines: DataFrame) -> DataFrame:
    rest = [c for c in lines.columns if c != "value"]
    return (
        lines.select(*rest, tx.strip_all(F.col("value")).alias("path"))
        .filter(F.col("path") != "")
        .withColumn("caption", F.lit(""))
    )


def read_filelist(spark: SparkSession, path: str, ordinal: bool = False) -> DataFrame:
    return parse_filelist(read_lines(spark, path, ordinal))


def choose_input(
    spark: SparkSession, pairs: str, filelist: str = "", mode: str = "failfast", ordinal: bool = False
) -> DataFrame:
    """Pairs when that path exists, else the file list, else an error."""
    try:
        return read_pairs(spark, pairs, mode, ordinal)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    if not filelist:
        raise ValueError(f"{pairs} not found and no file list given")
    return read_filelist(spark, filelist, ordinal)


def parse_manifest(lines: DataFrame) -> DataFrame:
    """Manifest records; malformed lines and records without a path are left out."""
    return (
        lines.select(tx.parsed_manifest_line(F.col("value")).alias("rec"))
        .select("rec.*")
        .filter(F.col("path").isNotNull())
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(read_lines(spark, path))


def _log_rows(lines: DataFrame) -> DataFrame:
    """One record per text line, NULL for a line that is something else.

    Records are made before the explode: a filter on them cannot move below it, so each line is parsed
    once.
    """
    rest = [c for c in lines.columns if c != "value"]
    line = tx.valid_text(F.col("value"))
    parts = F.when(line.rlike(_LINE_BREAKS), F.split(line, _LINE_BREAKS)).otherwise(F.array(line))
    return lines.select(*rest, F.explode(F.transform(parts, tx.parsed_log_line)).alias("rec"))


def parse_train_log(lines: DataFrame) -> DataFrame:
    """``step, loss, shard, form`` of the log lines; other lines are left out."""
    rest = [c for c in lines.columns if c != "value"]
    return (
        _log_rows(lines)
        .filter(F.col("rec.step").isNotNull() & F.col("rec.loss").isNotNull())
        .select(*rest, "rec.*")
    )


def train_log_counts(lines: DataFrame) -> DataFrame:
    """How many lines were used, looked like a log line but had no readable number, or were noise."""
    usable = F.col("rec.step").isNotNull() & F.col("rec.loss").isNotNull()
    kind = F.when(F.col("rec").isNull(), "unmatched").when(usable, F.col("rec.form")).otherwise("rejected")
    return _log_rows(lines).select(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def sorted_by_step(log: DataFrame) -> DataFrame:
    """Ascending by step; remaining columns break ties."""
    rest = [c for c in log.columns if c != "step"]
    return log.orderBy("step", *rest)


def read_train_log(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    log = parse_train_log(read_lines(spark, path))
    if strict and log.isEmpty():
        raise ValueError(f"no loss lines found in {path}")
    return log


def read_loss_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOSS_SCHEMA).csv(path, header=True)


# --- sinks ----------------------------------------------------------------------------------------


def write_filelist(files: DataFrame, path: str) -> None:
    """One path per line in order (part files in name order)."""
    files.orderBy("path").select("path").write.text(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """``path<TAB>caption`` lines with captions cleaned, so that the reader gets them back."""
    line = F.concat(F.col("path"), F.lit("\t"), tx.clean_caption(F.coalesce("caption", F.lit(""))))
    pairs.orderBy("path").select(line.alias("value")).write.text(path)


def append_loss(losses: DataFrame, path: str) -> None:
    losses.select("step", "loss").write.mode("append").csv(path, header=True)


def mark_done(archives: DataFrame, path: str, batch: str) -> None:
    """Store the finished archives of one batch: ``archive_id, archive``.

    Each batch is a folder that is overwritten as a whole, so a batch that is run again counts once.
    """
    rows = archives.select(F.col("archive_id").cast("bigint").alias("archive_id"), "archive").distinct()
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """``archive_id, archive`` of all finished archives; no rows when nothing is stored yet."""
    schema = "archive_id bigint, archive string"
    try:
        return spark.read.schema(f"{schema}, batch string").parquet(path).select("archive_id", "archive").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

"""Resume, skip and next-number operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import paths
from corpusmill.operators import ordered


def resume_remaining(rows: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose path is not in the manifest yet. Both sides are normalised first."""
    done = manifest.select(paths.normalised(F.col("path")).alias("_done")).distinct()
    return rows.join(done, paths.normalised(F.col(path)) == F.col("_done"), "left_anti")


def max_items(rows: DataFrame, n: int, order: list[str], partitions: int | None = None) -> DataFrame:
    """The first ``n`` rows in order; 0 means all. Runs before the resume filter, so finished rows
    count too."""
    if n <= 0:
        return rows
    return (
        ordered.with_ordinal(rows, order, name="_at", partitions=partitions)
        .filter(F.col("_at") < n)
        .drop("_at")
    )


def skip_processed(ids: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    return ids.join(done.select(key).distinct(), key, "left_anti")


def next_shard(names: DataFrame, name: Column, by: list[str] = []) -> DataFrame:
    """Largest shard number plus one; 0 when there is none."""
    number = F.max(paths.shard_number(name))
    return names.groupBy(*by).agg((F.coalesce(number, F.lit(-1)) + 1).alias("next"))


def next_archives(done: DataFrame, count: int, mode: str = "max", key: str = "id") -> DataFrame:
    """The next ``count`` archive ids: ``id, archive`` (zero-padded).

    ``max`` goes on after the largest finished id; ``gaps`` also fills the ids below it.
    """
    finished = done.select(F.col(key).cast("bigint").alias("id")).distinct()
    start = F.coalesce(finished.agg(F.max("id")).scalar(), F.lit(-1).cast("bigint")) + 1
    base = done.sparkSession.range(1)
    after = base.select(F.explode(F.sequence(start, start + (count - 1))).alias("id"))
    if mode == "max":
        found = after
    elif mode == "gaps":
        # The gap before each finished id is a run of ids; runs stay as (first, length) until cut.
        runs = ordered.previous_value(finished, "id", ["id"], name="_before").select(
            (F.coalesce("_before", F.lit(-1).cast("bigint")) + 1).alias("first"), F.col("id").alias("end")
        )
        open_runs = runs.filter(F.col("first") < F.col("end"))
        # Any run beyond the first `count` cannot contribute: each holds at least one id.
        lowest = open_runs.orderBy("first").limit(count)
        stop = F.least(F.col("end"), F.col("first") + count) - 1
        gaps = lowest.select(F.explode(F.sequence(F.col("first"), stop)).alias("id"))
        found = gaps.unionByName(after).orderBy("id").limit(count)
    else:
        raise ValueError("mode must be max or gaps")
    return found.select("id", paths.zero_pad(F.col("id")).alias("archive"))


def next_listed(listed: DataFrame, done: DataFrame, count: int, mode: str = "max", key: str = "id") -> DataFrame:
    """Rows of ``listed`` that hold the next ``count`` ids not done yet, whatever holes the numbers have.

    ``max`` takes ids above the largest finished one; ``gaps`` takes any that is not finished. Rows that
    share an id come together; a NULL id is never taken.
    """
    if mode not in ("max", "gaps"):
        raise ValueError("mode must be max or gaps")
    finished = done.select(F.col(key).cast("bigint").alias("_id")).distinct()
    ids = listed.select(F.col(key).cast("bigint").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    if mode == "max":
        ids = ids.filter(F.col("_id") > F.coalesce(finished.agg(F.max("_id")).scalar(), F.lit(-1).cast("bigint")))
    else:
        ids = ids.join(finished, "_id", "left_anti")
    wanted = ids.orderBy("_id").limit(count)
    return listed.join(F.broadcast(wanted), F.col(key) == F.col("_id")).drop("_id")


def next_runs(names: DataFrame) -> DataFrame:
    """Per day tag: the next run name."""
    pattern = paths.run_number_pattern()
    tag = F.regexp_extract("name", pattern, 1)
    number = F.regexp_extract("name", pattern, 2).try_cast("bigint")
    return (
        names.select(tag.alias("tag"), number.alias("number"))
        .filter(F.col("number").isNotNull())
        .groupBy("tag")
        .agg((F.max("number") + 1).alias("next"))
        .select("tag", paths.run_name(F.col("tag"), F.col("next")).alias("name"))
    )


def next_run_name(names: DataFrame, day: date) -> str:
    """The run name for one day: the day's largest number plus one, 01 when there is none."""
    tag = f"{day:%m_%d_%Y}"
    found = next_runs(names).filter(F.col("tag") == tag).head()
    return found["name"] if found else paths.RUN_NAME.format(date=tag, number="01")

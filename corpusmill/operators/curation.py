"""Exact deduplication, reason accounting, and the listing of kept files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.rules import DUPLICATE, HASH_FAIL, Rule, first_reject_reason
from corpusmill.session import shared_folder

OK = "ok"


def keepers(df: DataFrame, content_hash: str, order: str) -> DataFrame:
    """The first row of each hash in ``order``: ``hash, kept, copies``.

    A partial aggregate runs before the shuffle, so a hash that most rows share costs one row per
    task. Rows without a hash are dropped after it: a filter on the hash would compute it twice.
    """
    hashed = F.when(F.col(content_hash).isNotNull(), F.col(order))
    return (
        df.groupBy(content_hash)
        .agg(F.min(hashed).alias("kept"), F.count("*").alias("copies"))
        .filter(F.col("kept").isNotNull())
    )


def _verdicts(df: DataFrame, rules: Sequence[Rule], key: str, content: Column, keep: Sequence[str]) -> DataFrame:
    """``key, reason, _sha1``: rows that pass the rules are hashed, the others are not."""
    reason = first_reject_reason(rules)
    failed = F.coalesce(reason, F.when(content.isNull(), F.lit(HASH_FAIL)))
    return df.select(key, *keep, failed.alias("reason"), F.when(failed.isNull(), F.sha1(content)).alias("_sha1"))


def judge(
    df: DataFrame,
    rules: Sequence[Rule],
    key: str,
    content: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``key, *keep, reason`` per row: the first failing rule, NULL for a kept row.

    With ``content``, exact duplicates among the rows that pass the rules are rejected too; the
    smallest ``key`` of each content is kept. ``key`` must be unique. The contents are read once: the
    narrow verdicts are checkpointed, and the kept keys are joined back on ``key``, never on the
    hash, so copies stay spread out however many there are.
    """
    if content is None:
        return df.select(key, *keep, first_reject_reason(rules).alias("reason"))
    shared_folder(df.sparkSession)
    judged = _verdicts(df, rules, key, content, keep).checkpoint()
    kept = keepers(judged, "_sha1", key).select(F.col("kept").alias(key), F.lit(True).alias("_kept"))
    duplicate = F.when(F.col("_sha1").isNotNull() & F.col("_kept").isNull(), DUPLICATE)
    return (
        judged.join(kept, key, "left")
        .withColumn("reason", F.coalesce("reason", duplicate))
        .drop("_kept", "_sha1")
    )


def judged_groups(df: DataFrame, rules: Sequence[Rule], key: str, content: Column) -> DataFrame:
    """The same verdicts summed up per reason and content: ``reason, _sha1, n, first, kept``.

    Enough for the counts and for the list of kept rows, with one scan and one aggregate, so nothing
    is joined. A group with a NULL reason is one kept row (``kept``) and ``n - 1`` duplicates.
    """
    passed = F.when(F.col("reason").isNull(), F.col(key))
    return (
        _verdicts(df, rules, key, content, ())
        .groupBy("reason", "_sha1")
        .agg(F.count("*").alias("n"), F.min(key).alias("first"), F.min(passed).alias("kept"))
    )


def kept_of_groups(groups: DataFrame, key: str) -> DataFrame:
    # A filter on ``reason`` would move below the aggregate and run the rules twice.
    return groups.filter(F.col("kept").isNotNull()).select(F.col("kept").alias(key))


def group_reason_counts(groups: DataFrame, include_ok: bool = False) -> DataFrame:
    """:func:`reason_counts` from groups. Among equal counts, duplicates stand at the first row that
    has a copy."""
    passed = F.col("reason").isNull()
    split = F.when(
        passed,
        F.array(
            F.struct(F.lit(OK).alias("reason"), F.lit(1).cast("bigint").alias("n")),
            F.struct(F.lit(DUPLICATE).alias("reason"), (F.col("n") - 1).alias("n")),
        ),
    ).otherwise(F.array(F.struct(F.col("reason").alias("reason"), F.col("n").alias("n"))))
    rows = groups.select("first", F.explode(split).alias("r")).select("first", "r.*").filter("n > 0")
    if not include_ok:
        rows = rows.filter(F.col("reason") != OK)
    return (
        rows.groupBy("reason")
        .agg(F.sum("n").alias("n"), F.min("first").alias("_first"))
        .orderBy(F.desc("n"), "_first")
        .drop("_first")
    )


def group_summary(groups: DataFrame) -> DataFrame:
    valid = F.count_if(F.col("reason").isNull())
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"),
        valid.alias("valid"),
        (F.coalesce(F.sum("n"), F.lit(0)) - valid).alias("rejected"),
    )


def keep_valid(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).drop("reason")


def reason_counts(judged: DataFrame, key: str, include_ok: bool = False) -> DataFrame:
    """``reason, n`` by falling count, ties in first-seen order."""
    reason = F.coalesce("reason", F.lit(OK)) if include_ok else F.col("reason")
    counted = judged.select(reason.alias("reason"), key)
    if not include_ok:
        counted = counted.filter(F.col("reason").isNotNull())
    return (
        counted.groupBy("reason")
        .agg(F.count("*").alias("n"), F.min(key).alias("_first"))
        .orderBy(F.desc("n"), "_first")
        .drop("_first")
    )


def funnel_summary(judged: DataFrame) -> DataFrame:
    """One row: candidates, valid, rejected; candidates = valid + rejected."""
    return judged.agg(
        F.count("*").alias("candidates"),
        F.count_if(F.col("reason").isNull()).alias("valid"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )


def skip_existing(targets: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """Targets that are not there yet."""
    return targets.join(listing.select(path).distinct(), path, "left_anti")


def dataset_bytes(listing: DataFrame, folder: str, size: str) -> DataFrame:
    """Objects and total bytes per folder."""
    return listing.groupBy(folder).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))

"""Run analytics: coverage, exact describe, step times, file retention."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusmill.operators import ordered
from corpusmill.session import shared_folder

# The number of shards listed, and the cache budget in GiB.
TOP_SHARDS = 20
CACHE_GB = 50
QUARTILES = (0.25, 0.5, 0.75)


def shard_coverage(
    log: DataFrame, shard: str = "shard", topk: int = TOP_SHARDS, order: str = "step"
) -> DataFrame:
    """The most frequent shards: ``shard, n, percent, hidden`` (how many shards are not listed).

    Rows without a shard are left out. Equal counts stand in first-seen order, then by name. The counts
    are stored, so that the log is read once for the list and its totals.
    """
    shared_folder(log.sparkSession)
    counts = (
        log.filter(F.col(shard).isNotNull())
        .groupBy(F.col(shard).alias("shard"))
        .agg(F.count("*").alias("n"), F.min(order).alias("_first"))
        .checkpoint()
    )
    total = counts.agg(F.sum("n")).scalar()
    shards = counts.agg(F.count("*")).scalar()
    return (
        counts.orderBy(F.desc("n"), "_first", "shard")
        .limit(topk)
        .select(
            "shard",
            "n",
            (F.lit(100.0) * F.col("n") / total).alias("percent"),
            F.greatest(shards - topk, F.lit(0)).cast("bigint").alias("hidden"),
        )
    )


def coverage_totals(log: DataFrame, shard: str = "shard", topk: int = TOP_SHARDS) -> DataFrame:
    """One row beside :func:`shard_coverage`: ``lines`` of the log, ``total`` with a shard, ``unsharded`` without one, ``shards``, and ``hidden`` beyond ``topk``."""
    counts = log.groupBy(F.col(shard).alias("shard")).agg(F.count("*").alias("n"))
    none, named = F.lit(0).cast("bigint"), F.col("shard").isNotNull()
    return counts.agg(
        F.coalesce(F.sum("n"), none).alias("lines"),
        F.coalesce(F.sum(F.when(named, F.col("n"))), none).alias("total"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), none).alias("unsharded"),
        F.count_if(named).alias("shards"),
        F.greatest(F.count_if(named) - topk, none).alias("hidden"),
    )


# --- exact order statistics -----------------------------------------------------------------------

ACCURACY = 2000  # of the approximate quantiles that bound a rank, as one part in so many
INSIDE = 100_000  # distinct values fetched when a bracket is narrow enough


@dataclass
class _Bracket:
    """Where the value of one rank lies: above ``low`` and under ``high`` (None: no bound); ``below`` rows lie at or under ``low``, ``inside`` between."""

    column: str
    rank: int
    low: float | None
    high: float | None
    below: int
    inside: int

    def values(self) -> Column:
        """The column's values in the bracket, NULL elsewhere."""
        v = F.col(f"`{self.column}`")
        within = F.lit(True) if self.low is None else v > self.low
        return F.when(within if self.high is None else within & (v < self.high), v)


def _clean(name: str) -> Column:
    """The column as a double; NULL for NaN."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _stored(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.select(*[_clean(c).alias(c) for c in dict.fromkeys(columns)]).checkpoint()


def _bounds(values: Column, probs: Sequence[float]) -> Column:
    """Approximate quantiles a little below and above each probability."""
    asked = [min(1.0, max(0.0, p + d / ACCURACY)) for p in probs for d in (-2.0, 2.0)]
    return F.percentile_approx(values, asked, ACCURACY)


def _totals(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, Row]:
    """Count, moments, ends and approximate bounds of each column, in one pass without a shuffle of rows."""
    found = df.agg(
        *[
            F.struct(
                F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
                (_bounds(v, probs) if probs else F.lit(None)).alias("bounds"),
            ).alias(f"c{i}")
            for i, v in enumerate(F.col(f"`{c}`") for c in columns)
        ]
    ).first()
    return {c: found[f"c{i}"] for i, c in enumerate(columns)}


def _narrowed(df: DataFrame, brackets: Sequence[_Bracket], cuts: Sequence[Sequence[float]]) -> tuple[list[_Bracket], dict[tuple[str, int], float]]:
    """Count the rows under and at each cut, and keep the part between two cuts that holds the rank; or the rank's value, if it is a cut."""
    asked: dict[tuple[str, float], int] = {}
    for b, cut in zip(brackets, cuts):
        for c in cut:
            asked.setdefault((b.column, c), len(asked))
    counts = []
    for column, c in asked:
        v = F.col(f"`{column}`")
        counts += [F.count_if(v < c), F.count_if(v <= c)]
    row = df.agg(*[n.alias(f"n{i}") for i, n in enumerate(counts)]).first()
    left, done = [], {}
    for b, cut in zip(brackets, cuts):
        low, high, below, upto = b.low, b.high, b.below, b.below + b.inside
        for c in sorted(set(cut)):
            under, at = row[2 * asked[b.column, c]], row[2 * asked[b.column, c] + 1]
            if under <= b.rank < at:
                done[b.column, b.rank] = c
                break
            if at <= b.rank:
                low, below = c, at
            elif under < upto:
                high, upto = c, under
        else:
            left.append(_Bracket(b.column, b.rank, low, high, below, upto - below))
    return left, done


def _selected(df: DataFrame, wanted: dict[str, dict[int, tuple[float, float]]], ends: dict[str, Row]) -> dict[tuple[str, int], float]:
    """The exact value of each wanted rank (0-based, among the values of a column), by narrowing brackets.

    ``wanted`` has the first cuts of each rank. A pass counts for all ranks of all columns at once. A rank whose value is a cut is done, a bracket with few
    rows is fetched, any other gets approximate quantiles of its own as new cuts. Cuts are values that occur, so each pass takes some away.
    """
    done: dict[tuple[str, int], float] = {}
    left, cuts = [], []
    for column, ranks in wanted.items():
        for rank, first in ranks.items():
            left.append(_Bracket(column, rank, None, None, 0, ends[column]["count"]))
            cuts.append(first)
    while left:
        left, found = _narrowed(df, left, cuts)
        done |= found
        small = [b for b in left if b.inside <= INSIDE]
        if small:
            done |= _fetched(df, small)
        left = [b for b in left if b.inside > INSIDE]
        if left:
            at = [min(1.0, max(0.0, (b.rank - b.below + d * b.inside / ACCURACY) / b.inside)) for b in left for d in (-2.0, 2.0)]
            row = df.agg(*[F.percentile_approx(b.values(), at[2 * i : 2 * i + 2], ACCURACY).alias(f"q{i}") for i, b in enumerate(left)]).first()
            cuts = [tuple(row[f"q{i}"]) for i in range(len(left))]
    return done


def _fetched(df: DataFrame, brackets: Sequence[_Bracket]) -> dict[tuple[str, int], float]:
    """Ranks whose bracket holds at most ``INSIDE`` rows, from the values in it."""
    places = {(b.column, b.low, b.high): i for i, b in enumerate(brackets)}
    lists = df.agg(*[F.collect_list(brackets[i].values()).alias(f"v{i}") for i in places.values()]).first()
    held = {key: sorted(lists[f"v{i}"]) for key, i in places.items()}
    return {(b.column, b.rank): held[b.column, b.low, b.high][b.rank - b.below] for b in brackets}


def _interpolated(df: DataFrame, totals: dict[str, Row], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    """Quantile of each column and probability that has values."""
    wanted: dict[str, dict[int, tuple[float, float]]] = {}
    for column, row in totals.items():
        if not row["count"]:
            continue
        ranks = wanted.setdefault(column, {})
        for i, p in enumerate(probs):
            at = p * (row["count"] - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                ranks[rank] = tuple(row["bounds"][2 * i : 2 * i + 2])
    exact = _selected(df, wanted, totals)
    out = {}
    for column in wanted:
        for p in probs:
            at = p * (totals[column]["count"] - 1)
            a, b = exact[column, math.floor(at)], exact[column, math.ceil(at)]
            out[column, p] = a if a == b else a + (b - a) * (at - math.floor(at))
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Quantiles with linear interpolation: ``column, prob, value``. NULL and NaN are left out.

    ``percentile`` keeps every distinct value in the memory of one task. Here no row is sorted or shuffled: approximate quantiles bound each
    rank, then passes of partial aggregates count exactly how many rows lie below, until a bracket holds one value or at most ``INSIDE`` rows,
    which are fetched. A value that many rows share is found by its count. The asked columns are checkpointed, as they are read a few
    times, once per pass for all columns and ranks.
    """
    df = _stored(df, columns)
    found = _interpolated(df, _totals(df, columns, probs), probs)
    rows = [(c, float(p), v) for (c, p), v in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def describe_exact(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Count, mean, std (n-1), min, quartiles and max per column; a column without values has count 0.

    All moments come from one pass; the quartiles as in :func:`exact_quantiles`. ``approximate`` takes the quartiles from ``percentile_approx`` instead,
    in that same pass.
    """
    df = _stored(df, columns)
    if approximate:
        totals = _totals(df, columns, ())
        row = df.agg(*[F.percentile_approx(F.col(f"`{c}`"), list(QUARTILES), 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
        quartiles = {(c, p): row[f"q{i}"][k] for i, c in enumerate(columns) if row[f"q{i}"] for k, p in enumerate(QUARTILES)}
    else:
        totals = _totals(df, columns, QUARTILES)
        quartiles = _interpolated(df, totals, QUARTILES)
    rows = [
        (c, t["count"], t["mean"], t["std"], t["min"], *[quartiles.get((c, p)) for p in QUARTILES], t["max"]) for c, t in totals.items()
    ]
    numbers = ", ".join(f"{x} double" for x in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count bigint, {numbers}")


def interval_seconds(interval: Column) -> Column:
    """A day-time interval as seconds, independent of the session's time zone."""
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    total = F.lit(0.0)
    for unit, seconds in parts.items():
        total = total + F.extract(F.lit(unit), interval).cast("double") * seconds
    return total


def step_seconds(
    log: DataFrame, at: str, order: Sequence[str], by: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Seconds since the row before, NULL on the first row of a run."""
    before = ordered.previous_value(log, at, order, by, "_before", partitions)
    return before.withColumn("seconds", interval_seconds(F.col(at) - F.col("_before"))).drop("_before")


def last_access(log: DataFrame, name: str = "name", at: str = "ts", size: str = "bytes") -> DataFrame:
    """Latest access of each file and its size then."""
    return log.groupBy(name).agg(F.max(at).alias(at), F.max_by(size, at).alias(size))


def retain_within_budget(
    files: DataFrame,
    max_bytes: Column | int = CACHE_GB * 1024**3,
    name: str = "name",
    at: str = "ts",
    size: str = "bytes",
    partitions: int | None = None,
) -> DataFrame:
    """Which files a least-recently-used cache of ``max_bytes`` still holds: adds ``kept``.

    The files kept are the longest run of most recent ones whose sizes fit together.
    """
    budget = F.lit(max_bytes) if isinstance(max_bytes, int) else max_bytes
    summed = ordered.running_sum(files, size, [F.desc(at), name], name="_held", partitions=partitions)
    return summed.withColumn("kept", F.col("_held") <= budget).drop("_held")


def cache_bytes(files: DataFrame, size: str = "bytes") -> DataFrame:
    return files.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))

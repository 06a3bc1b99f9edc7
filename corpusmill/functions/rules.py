"""Validation rules and the first-failing-rule verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reasons a file is rejected for, and the default limits.
CORRUPT = "corrupt_or_unreadable"
TOO_SMALL = "too_small"
BAD_ASPECT = "bad_aspect_ratio"
HASH_FAIL = "hash_fail"
DUPLICATE = "duplicate_sha1"
MIN_SIDE = 256
MIN_ASPECT = 0.5
MAX_ASPECT = 2.0

Rule = tuple[str, Column]


def verdict(width: Column, height: Column) -> Column:
    """``ok, reason, width, height`` of a decoded image; the image source gives -1 for a bad file."""
    ok = F.coalesce((width >= 0) & (height >= 0), F.lit(False))
    return F.struct(
        ok.alias("ok"),
        F.when(ok, "ok").otherwise(CORRUPT).alias("reason"),
        F.when(ok, width).cast("int").alias("width"),
        F.when(ok, height).cast("int").alias("height"),
    )


def too_small(width: Column, height: Column, min_side: int = MIN_SIDE) -> Column:
    return F.least(width, height) < F.lit(min_side)


def aspect_ratio(width: Column, height: Column) -> Column:
    """Width over height; 0.0 for height 0."""
    return F.coalesce(F.try_divide(width.cast("double"), height.cast("double")), F.lit(0.0))


def within_aspect(
    width: Column, height: Column, low: float = MIN_ASPECT, high: float = MAX_ASPECT
) -> Column:
    return aspect_ratio(width, height).between(F.lit(float(low)), F.lit(float(high)))


def first_reject_reason(rules: Sequence[Rule]) -> Column:
    """Name of the first failing rule, NULL when none fails. One CASE, so later rules are not run."""
    (name, failed), *rest = rules
    reason = F.when(failed, F.lit(name))
    for name, failed in rest:
        reason = reason.when(failed, F.lit(name))
    return reason


def size_rules(
    width: Column,
    height: Column,
    min_side: int = MIN_SIDE,
    min_aspect: float = MIN_ASPECT,
    max_aspect: float = MAX_ASPECT,
) -> list[Rule]:
    return [
        (CORRUPT, width.isNull() | height.isNull() | (width < 0) | (height < 0)),
        (TOO_SMALL, too_small(width, height, min_side)),
        (BAD_ASPECT, ~within_aspect(width, height, min_aspect, max_aspect)),
    ]

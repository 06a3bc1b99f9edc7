"""Broadcast only after a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Narrow key rows; about 50 MB at 100 bytes each.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` has at most ``max_rows`` rows, else leave the join to Spark.

    The check stops reading after ``max_rows + 1`` rows. Use it on narrow tables only.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df

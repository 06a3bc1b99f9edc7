"""Query registry and SQL text helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def r6(x: Column) -> Column:
    """Rounded for comparison; adding 0.0 turns -0.0 into 0.0."""
    return F.round(x, 6) + F.lit(0.0)


def sql_r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"

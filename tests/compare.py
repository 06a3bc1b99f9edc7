"""Run a query in Spark and its SQL in DuckDB on the same files and compare the rows."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs: columns, types, row count, first differing rows. Empty when all is equal."""
    got_cols, got = _sorted(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.sql(sql)
    want_cols, want = _sorted(list(result.columns), result.fetchall())
    found = []
    if got_cols != want_cols:
        return [f"columns {got_cols} != {want_cols}"]
    types = dict(zip(result.columns, map(str, result.types)))
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind, kind) != types[name]:
            found.append(f"type of {name}: {kind} != {types[name]}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    bad = [(a, c) for a, c in zip(got, want) if a != c]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[:3]}")
    return found

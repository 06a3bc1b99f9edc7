"""Random numbers as a pure function of (seed, key, slot).

``rand(seed)`` depends on how rows are partitioned, so a lost executor or another cluster size would
change the draws. These depend on the row's key only. ``md5`` can be repeated by any SQL engine;
``xxhash`` stays inside generated code. ``philox`` is for noise of long arrays: a counter-based
generator per row, keyed by the row's hash, in Arrow batches; lambdas over arrays run element by element
in the JVM and are many times slower there. Single numbers under ``philox`` are those of ``xxhash``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

METHODS = ("md5", "xxhash", "philox")


def _check(method: str) -> None:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def digest(seed: int, *key: Column) -> Column:
    """Hex md5 of ``seed:key...``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key]))


def _hex_unit(hexed: Column, start: int) -> Column:
    return F.conv(F.substring(hexed, start, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def _long_unit(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 11) * F.lit(2.0**-53)


def uniform(seed: int, *key: Column, method: str = "md5") -> Column:
    """Uniform in [0, 1)."""
    _check(method)
    if method != "md5":
        return _long_unit(F.xxhash64(F.lit(seed), *key))
    return _hex_unit(digest(seed, *key), 1)


def uniform_int(n: Column | int, seed: int, *key: Column, method: str = "md5") -> Column:
    """Uniform integer in [0, n)."""
    size = F.lit(n) if isinstance(n, int) else n
    return F.floor(uniform(seed, *key, method=method) * size).cast("bigint")


def order_key(seed: int, *key: Column) -> Column:
    """A sort key that shuffles rows; add the key itself as tie-break."""
    return digest(seed, *key)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _philox_normal(hashed: pd.Series, size: pd.Series) -> pd.Series:
    keys = hashed.to_numpy(dtype=np.int64).view(np.uint64)
    return pd.Series(
        [
            np.random.Generator(np.random.Philox(key=key)).standard_normal(max(n, 0))
            for key, n in zip(keys, size)
        ],
        dtype=object,
    )


def gaussian_array(n: Column | int, seed: int, *key: Column, method: str = "md5") -> Column:
    """``n`` standard normal values: by the Box-Muller transform, two per hash, or by ``philox``."""
    _check(method)
    size = F.lit(n) if isinstance(n, int) else n
    if method == "philox":
        return _philox_normal(F.xxhash64(F.lit(seed), *key), size.cast("int"))

    def two(u1: Column, u2: Column) -> Column:
        radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1))
        angle = F.lit(2.0) * F.pi() * u2
        return F.array(radius * F.cos(angle), radius * F.sin(angle))

    def pair(p: Column) -> Column:
        if method == "xxhash":
            return two(
                _long_unit(F.xxhash64(F.lit(seed), *key, p, F.lit(1))),
                _long_unit(F.xxhash64(F.lit(seed), *key, p, F.lit(2))),
            )
        return let(digest(seed, *key, p), lambda h: two(_hex_unit(h, 1), _hex_unit(h, 14)))

    pairs = F.sequence(F.lit(0), ((size - 1) / 2).cast("int"))
    values = F.slice(F.flatten(F.transform(pairs, pair)), 1, size)
    return F.when(size <= 0, F.array().cast("array<double>")).otherwise(values)

"""Global order without a single task.

A window with an ORDER BY and no PARTITION BY moves every row to one task, and a window over a hot
group moves that group to one task. The operators here range-partition rows by ``(by, order)``
instead, so that a group of any size spreads over as many partitions as it needs:

1. rows are range-partitioned and sorted, the only shuffle of data; the partition number is the *segment*;
2. the scan runs over the sorted batches of a segment, inside its groups, before anything is stored;
3. the result is checkpointed, so that segment numbers stay fixed for all later reads, also when an
   executor is lost;
4. only the first group of a segment can continue from the segment before, so what is carried over is
   at most one value per segment. These few rows (bounded by the number of partitions, like the
   boundaries Spark itself samples for a sort) are chained and broadcast. Groups are compared by Spark itself and
   never turned into text, so keys of any type that can be grouped by keep their full value; NULLs are one group, and so are NaNs.

``order`` must be unique within a group (add a tie-break column); equal keys cannot be split. Rows pass through Arrow,
so their columns need types that Arrow has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusmill.operators.sizing import broadcast_if_small
from corpusmill.session import shared_folder

SEG = "_seg"
POS = "_pos"

ColumnOrName = Column | str


def _range_sorted(df: DataFrame, keys: Sequence[ColumnOrName], partitions: int | None) -> DataFrame:
    shared_folder(df.sparkSession)
    if partitions:
        spread = df.repartitionByRange(partitions, *keys)
    else:
        spread = df.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys)


def _group(by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))


def _changes(column: pa.Array) -> np.ndarray:
    """For each value but the first whether it differs from the one before; NULLs are equal, and NaNs."""
    if len(column) < 2:
        return np.zeros(0, dtype=bool)
    if pa.types.is_nested(column.type):
        values = [repr(v) for v in column.to_pylist()]
        return np.array([a != b for a, b in zip(values[1:], values)])
    after, before = column.slice(1), column.slice(0, len(column) - 1)
    differs = pc.fill_null(pc.not_equal(after, before), False).to_numpy(zero_copy_only=False)
    one_null = pc.xor(pc.is_null(after), pc.is_null(before)).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(column.type):
        nan = pc.fill_null(pc.and_(pc.is_nan(after), pc.is_nan(before)), False).to_numpy(zero_copy_only=False)
        differs = differs & ~nan
    return differs | one_null


def _runs(batch: pa.RecordBatch, by: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number the runs of equal groups (rows are sorted, so a run is a group) and give each row its run's start."""
    change = np.zeros(batch.num_rows, dtype=bool)
    for name in by:
        change[1:] |= _changes(batch.column(name))
    change[:1] = True
    return np.cumsum(change) - 1, np.flatnonzero(change)[np.cumsum(change) - 1]


def _same_group(last: pa.RecordBatch | None, batch: pa.RecordBatch, by: Sequence[str]) -> bool:
    """Whether the first row of a batch continues the group of the row before it."""
    if last is None:
        return False
    return not any(_changes(pa.concat_arrays([last.column(c), batch.column(c).slice(0, 1)]))[0] for c in by)


class _Ordinal:
    """1-based place in the group."""

    fields = [("_local", pa.int64())]
    held = 0

    def __call__(self, batch: pa.RecordBatch, codes: np.ndarray, starts: np.ndarray, joined: bool) -> list[pa.Array]:
        place = np.arange(1, len(codes) + 1) - starts
        if joined:
            place[codes == 0] += self.held
        self.held = int(place[-1])
        return [pa.array(place)]


class _Sum:
    """Running sum in the group; NULL until there is a value. Integers and decimals are exact."""

    def __init__(self, value: str, kind: pa.DataType):
        self.value, self.kind, self.fields = value, kind, [("_local", kind)]
        self.held, self.seen = 0, False

    def __call__(self, batch: pa.RecordBatch, codes: np.ndarray, starts: np.ndarray, joined: bool) -> list[pa.Array]:
        column = batch.column(self.value)
        valid = pc.is_valid(column).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(self.kind):
            values = pd.Series(column.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
            total = values.groupby(codes).cumsum(skipna=False).to_numpy()
        else:
            values = self._whole(column)
            so_far = np.cumsum(values)
            total = so_far - so_far[starts] + values[starts]
        count = np.cumsum(valid)
        any_valid = count - count[starts] + valid[starts] > 0
        if joined:
            total[codes == 0] += self.held
            any_valid[codes == 0] |= self.seen
        self.held, self.seen = total[-1], bool(any_valid[-1])
        return [pa.array(total if total.dtype != object else total.tolist(), type=self.kind, mask=~any_valid)]

    def _whole(self, column: pa.Array) -> np.ndarray:
        """Integers as they are while their sums are far from the limit, else Python numbers, which do not overflow; the cast to the type
        refuses what it cannot hold."""
        if pa.types.is_integer(column.type):
            values = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            if np.abs(values.astype(float)).sum() + abs(float(self.held)) < 2.0**62:
                return values
        return np.array([0 if v is None else v for v in column.to_pylist()], dtype=object)


class _Lag:
    """Value of the row before in the group, and whether a row is the first of its group here."""

    def __init__(self, value: str, kind: pa.DataType):
        self.value, self.fields, self.last = value, [("_local", kind), ("_head", pa.bool_())], None

    def __call__(self, batch: pa.RecordBatch, codes: np.ndarray, starts: np.ndarray, joined: bool) -> list[pa.Array]:
        column = batch.column(self.value)
        head = starts == np.arange(len(starts))
        before = self.last if joined else pa.nulls(1, column.type)
        head[0] = not joined
        shifted = pa.concat_arrays([before, column.slice(0, len(column) - 1)])
        inner = np.flatnonzero(head)
        keep = np.arange(len(column))
        shifted = shifted.take(pa.array(keep, mask=np.isin(keep, inner)))
        self.last = column.slice(len(column) - 1)
        return [shifted, pa.array(head)]


Scan = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, bool], list[pa.Array]]


def _scanned(batches: Iterator[pa.RecordBatch], by: Sequence[str], scan: Scan) -> Iterator[pa.RecordBatch]:
    segment = TaskContext.get().partitionId()
    last, offset = None, 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        codes, starts = _runs(batch, by)
        found = scan(batch, codes, starts, _same_group(last, batch, by))
        place = [pa.array(np.full(n, segment, dtype=np.int32)), pa.array(np.arange(offset, offset + n, dtype=np.int64))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *place, *found], names=[*batch.schema.names, SEG, POS, *[f for f, _ in scan.fields]])
        last, offset = batch.slice(n - 1), offset + n


def _segments(
    df: DataFrame, order: Sequence[ColumnOrName], by: Sequence[str], partitions: int | None, make: Callable[[], Scan], fields: Sequence[T.StructField]
) -> DataFrame:
    """Rows in ``(by, order)`` order with their segment, their place in it and what the scan adds, checkpointed."""
    by = list(by)
    schema = T.StructType([*df.schema.fields, T.StructField(SEG, T.IntegerType()), T.StructField(POS, T.LongType()), *fields])
    sorted_rows = _range_sorted(df, [*by, *order], partitions)
    return sorted_rows.mapInArrow(lambda batches: _scanned(batches, by, make()), schema).checkpoint()


Step = Callable[[Any, Any], Any]


def _edges(segments: DataFrame, by: Sequence[str], tail: Column) -> DataFrame:
    """One row per segment: its first group, the ``tail`` of its last row, whether it goes on from the segment before (``cont``)
    and lies in one group (``one``)."""
    ends = segments.groupBy(SEG).agg(
        F.min_by(_group(by), POS).alias("first"), F.max_by(_group(by), POS).alias("last"), F.max_by(F.struct(tail.alias("tail")), POS).alias("end")
    )
    before = Window.orderBy(SEG)
    return ends.select(
        SEG, "first", "end", F.lag("last").over(before).eqNullSafe(F.col("first")).alias("cont"), F.col("first").eqNullSafe(F.col("last")).alias("one"),
        F.lag("end").over(before).alias("previous"),
    )


def _carried(segments: DataFrame, by: Sequence[str], few: DataFrame) -> DataFrame:
    """Add ``_carry`` of ``few`` (segment, ``first``, ``_in``) to the rows of each segment's first group."""
    few = few.select(SEG, F.col("first").alias("_first"), "_in")
    joined = segments.join(F.broadcast(few), SEG, "left")
    return joined.withColumn("_carry", F.when(_group(by).eqNullSafe(F.col("_first")), F.col("_in"))).drop("_first", "_in")


def _carry(segments: DataFrame, by: Sequence[str], tail: Column, step: Step, kind: T.DataType) -> DataFrame:
    """Add ``_carry``: for rows of a segment's first group, what that group brings from before.

    ``tail`` is taken at the last row of each segment. ``step(carried, tail)`` is the state after a
    segment that lies wholly within one group and continues it; otherwise the state is ``step(None,
    tail)``.
    """
    edges = _edges(segments, by, tail).checkpoint()
    carried, state = [], None
    for row in edges.select(SEG, "cont", "one", "end").orderBy(SEG).collect():
        if row["cont"]:
            carried.append((row[SEG], state))
        state = step(state if row["cont"] and row["one"] else None, row["end"]["tail"])
    if not carried:
        return segments.withColumn("_carry", F.lit(None).cast(kind))
    states = segments.sparkSession.createDataFrame(carried, T.StructType([T.StructField(SEG, T.IntegerType()), T.StructField("_in", kind)]))
    return _carried(segments, by, edges.select(SEG, "first").join(F.broadcast(states), SEG))


def _add(carried: Any, tail: Any) -> Any:
    if carried is None or tail is None:
        return tail if carried is None else carried
    return tail + carried


def with_ordinal(
    df: DataFrame,
    order: Sequence[ColumnOrName],
    by: Sequence[str] = (),
    name: str = "ordinal",
    partitions: int | None = None,
) -> DataFrame:
    """0-based position in the given order, over all rows or within each ``by`` group.

    Pass narrow rows (keys); join wide payloads to the result on their key afterwards, or use
    :func:`number_rows`.
    """
    segments = _segments(df, order, by, partitions, _Ordinal, [T.StructField("_local", T.LongType())])
    numbered = _carry(segments, by, F.col("_local"), _add, T.LongType())
    ordinal = F.col("_local") - 1 + F.coalesce("_carry", F.lit(0))
    return numbered.withColumn(name, ordinal).drop(SEG, POS, "_local", "_carry")


def number_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "ordinal",
    partitions: int | None = None,
) -> DataFrame:
    """:func:`with_ordinal` for wide rows: only the keys are sorted, the payload is joined last.

    ``key`` must be unique. While the numbers are few they are broadcast, and the payload is not
    shuffled at all.
    """
    narrow = df.select(*dict.fromkeys([key, *by, *order]))
    numbered = with_ordinal(narrow, order, by, name, partitions).select(key, name)
    return df.join(broadcast_if_small(numbered), key)


def running_sum(
    df: DataFrame,
    value: str,
    order: Sequence[ColumnOrName],
    by: Sequence[str] = (),
    name: str = "running",
    partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sum of ``value`` in the given order. Integers add up to BIGINT, decimals to ten more digits, others to DOUBLE."""
    kind = df.select(F.sum(value).alias("s")).schema["s"].dataType
    arrow = to_arrow_type(kind)
    segments = _segments(df, order, by, partitions, lambda: _Sum(value, arrow), [T.StructField("_local", kind)])
    carried = _carry(segments, by, F.col("_local"), _add, kind)
    total = F.when(F.col("_carry").isNull(), F.col("_local")).otherwise((F.coalesce("_local", F.lit(0).cast(kind)) + F.col("_carry")).cast(kind))
    return carried.withColumn(name, total).drop(SEG, POS, "_local", "_carry")


def previous_value(
    df: DataFrame,
    value: str,
    order: Sequence[ColumnOrName],
    by: Sequence[str] = (),
    name: str = "previous",
    partitions: int | None = None,
) -> DataFrame:
    """Value of the row before (``lag``) in the given order; NULL on the first row of a group."""
    kind = df.schema[value].dataType
    fields = [T.StructField("_local", kind), T.StructField("_head", T.BooleanType())]
    segments = _segments(df, order, by, partitions, lambda: _Lag(value, to_arrow_type(kind)), fields)
    edges = _edges(segments, by, F.col(value))
    few = edges.filter("cont").select(SEG, "first", F.col("previous.tail").alias("_in"))
    before = F.when(F.col("_head"), F.col("_carry")).otherwise(F.col("_local"))
    return _carried(segments, by, few).withColumn(name, before).drop(SEG, POS, "_local", "_head", "_carry")


# --- exponential moving average -------------------------------------------------------------------


def fold_runs(values: np.ndarray, codes: np.ndarray, starts: np.ndarray, alpha: float) -> np.ndarray:
    """The average of each run on its own, starting at the run's first value."""
    series = pd.Series(values)
    if alpha == 1.0:
        out = values[starts]
    else:
        out = series.groupby(codes).ewm(alpha=1.0 - alpha, adjust=False).mean().to_numpy(dtype=float)
    poisoned = series.isna().groupby(codes).cummax().to_numpy()
    return np.where(poisoned, np.nan, out)


class _Ema:
    """Average of each group on its own, with the place in the group and the group's first value."""

    fields = [("_k", pa.int64()), ("_start", pa.float64()), ("_ema", pa.float64())]

    def __init__(self, value: str, alpha: float):
        self.value, self.alpha, self.held = value, alpha, None

    def __call__(self, batch: pa.RecordBatch, codes: np.ndarray, starts: np.ndarray, joined: bool) -> list[pa.Array]:
        values = batch.column(self.value).to_pandas().to_numpy(dtype=float)
        out = fold_runs(values, codes, starts, self.alpha)
        k = np.arange(len(values)) - starts
        start = values[starts]
        if joined:
            head = codes == 0
            last, last_k, first = self.held
            out = np.where(head, out + self.alpha ** (k + 1) * (last - start), out)
            k = np.where(head, k + last_k + 1, k)
            start = np.where(head, first, start)
        self.held = (out[-1], k[-1], start[-1])
        return [pa.array(k.astype(np.int64)), pa.array(start), pa.array(out)]


def ema(
    df: DataFrame,
    value: str,
    order: Sequence[ColumnOrName],
    by: Sequence[str] = (),
    alpha: float = 0.98,
    name: str = "ema",
    partitions: int | None = None,
) -> DataFrame:
    """``v0 = x0; v = alpha*v + (1-alpha)*x`` in the given order, per ``by`` group.

    The recursion is affine, so a segment can be folded on its own and corrected with the end value
    of the segment before: ``ema = local + alpha**(k+1) * (carry - start)``. From a NaN (or NULL)
    value on, the average of that group is NaN, as in the plain recursion.
    """
    if not 0.0 <= alpha <= 1.0:
        raise ValueError("alpha must be within [0, 1]")
    fields = [T.StructField("_k", T.LongType()), T.StructField("_start", T.DoubleType()), T.StructField("_ema", T.DoubleType())]
    local = _segments(df, order, by, partitions, lambda: _Ema(value, alpha), fields)

    def after(carried: float | None, tail: Any) -> float:
        if carried is None:
            return tail["_ema"]
        return tail["_ema"] + alpha ** (tail["_k"] + 1) * (carried - tail["_start"])

    joined = _carry(local, by, F.struct("_k", "_start", "_ema"), after, T.DoubleType())
    corrected = F.col("_ema") + F.pow(F.lit(alpha), F.col("_k") + 1) * (F.col("_carry") - F.col("_start"))
    smoothed = F.when(F.col("_carry").isNull(), F.col("_ema")).otherwise(corrected)
    return joined.withColumn(name, smoothed).drop(SEG, POS, "_k", "_start", "_ema", "_carry")

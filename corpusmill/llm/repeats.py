"""Removal of long repeated byte strings by distributed prefix doubling on sampled positions.

A suffix array over all bytes would shuffle one row per byte for each round. Here the rows are *anchors*: of the ``LENGTH``
bytes of a window, the position whose ``SEED`` bytes have the least hash (the leftmost of equals). Equal windows have their
anchor at the same place, so anchors are all that has to be ranked, one for about every 40 bytes. The rank of a position at a length is
a hash of that many bytes; positions leave as soon as they are unique.

1. ``SEED`` bytes: anchors are ranked alone; one that is unique has only unique windows and leaves.
2. The whole stretch of an anchor's windows: of anchors with equal stretches, all but the earliest are repeats. Each task
   does this first for the rows it holds, so a text that is copied a million times is shuffled once per task, not a million times.
3. Half-windows beside the anchor: the earliest anchors of different stretches look for windows they share. A window reaches
   at least ``REACH`` bytes to one side of its anchor, so windows whose half is unique leave.
4. ``LENGTH`` bytes: the windows left are ranked by the pair of ranks of their first and last ``HALF`` bytes; all but the earliest of
   a pair are repeats.

Ranks are shuffled by their value, and a rank that many rows share is first reduced to its least position in
each task. Repeats become byte intervals, merged per document. Equality is equality of two 64-bit hashes of different parts.

Defined results: NULL and empty texts have no bytes. A NULL id comes before all others. Rows that share an id are the same
document to the order (a string at the same start in both is not earlier in either), but each is cut by its own text; equal rows
are cut alike. Further columns are ignored by ``repeats``. A text longer than ``PIECE`` bytes is worked on in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import bytetext
from corpusmill.session import scratch_folder

LENGTH = 100
SEED = 24
REACH = (LENGTH - SEED) // 2
HALF = 64
PIECE = 1 << 20
_NO_ID = -(1 << 63)


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each run of ``width`` values."""
    n = len(values) - width + 1
    best, at, span = values, np.arange(len(values)), 1
    # Doubling: minima of 2**k values from minima of 2**(k-1), then two overlapping ones.
    while span * 2 <= width:
        a, b = best[: len(best) - span], best[span:]
        right = b < a
        best, at = np.where(right, b, a), np.where(right, at[span:], at[: len(at) - span])
        span *= 2
    shift = width - span
    a, b = best[:n], best[shift : shift + n]
    return np.where(b < a, at[shift : shift + n], at[:n])


def _pieces(block: bytetext.Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, bounds, row and offset of each text of a block; a long text comes in overlapping pieces."""
    if block.rows > 1 or len(block.data) <= PIECE:
        n = block.rows
        yield block.data, block.bounds, np.arange(n), np.zeros(n, dtype=np.int64)
        return
    for at in range(0, len(block.data) - LENGTH + 1, PIECE):
        part = block.data[at : at + PIECE + LENGTH - 1]
        yield part, np.array([0, len(part)]), np.zeros(1, dtype=np.int64), np.array([at])


def _windows(data: np.ndarray, bounds: np.ndarray):
    """Hash prefix and, for each run of window starts that share an anchor: first start, last start, anchor, text number."""
    prefix = bytetext.prefix_hash(data)
    n = len(data) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return prefix, none, none, none, none
    seeds = bytetext.mix(bytetext.window_hash(prefix, SEED, len(data) - SEED + 1))
    anchor = _sliding_argmin(seeds, LENGTH - SEED + 1)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    fits = owner[:n] == owner[LENGTH - 1 :]
    change = np.ones(n, dtype=bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (fits[1:] != fits[:-1]) | (owner[1:n] != owner[: n - 1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], n) - 1
    good = fits[first]
    first, last = first[good], last[good]
    return prefix, first, last, anchor[first], owner[first]


def _merged(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the intervals of each row."""
    order = np.lexsort((start, rows))
    rows, start, end = rows[order], start[order], end[order]
    if not len(rows):
        return rows, start, end
    new = np.ones(len(rows), dtype=bool)
    big = int(end.max()) + 1
    reach = np.maximum.accumulate(rows.astype(np.int64) * big + end)
    new[1:] = rows[1:].astype(np.int64) * big + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return rows[at], start[at], np.maximum.reduceat(end, at)


_ANCHORS = "part int, seed bigint, stretch bigint, id bigint, tie bigint, at bigint, low int, high int"
_ANCHOR_NAMES = [x.split()[0] for x in _ANCHORS.split(", ")]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of ``id, tie, text`` rows (part 0), reduced to the earliest of equal stretches; intervals of the others (part 1).

    Of a part 1 row, ``at`` is the start and ``stretch`` the end of an interval, and ``seed`` spreads the rows.
    """
    for batch in batches:
        ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        found: list[np.ndarray] = []
        held = 0
        for block in bytetext.blocks(batch.column(2)):
            for data, bounds, rows, offset in _pieces(block):
                prefix, first, last, anchor, text = _windows(data, bounds)
                if not len(first):
                    continue
                seed = bytetext.span_hash(prefix, anchor, anchor + SEED)
                stretch = bytetext.span_hash(prefix, first, last + LENGTH)
                low, high = anchor - first, last - first
                # The stretch also tells where the anchor lies in it.
                stretch = bytetext.mix(stretch + (low * 4096 + high).astype(np.uint64) * bytetext.U64(0xD6E8FEB86659FD93))
                row = block.first + rows[text]
                at = anchor - bounds[text] + offset[text]
                found.append(np.stack([bytetext.mix(seed).view(np.int64), stretch.view(np.int64), row, at, low, high]))
                held += len(first)
            if held > 400_000:
                yield from _reduced(found, ids, ties)
                found, held = [], 0
        if held:
            yield from _reduced(found, ids, ties)


def _reduced(found: list[np.ndarray], ids: np.ndarray, ties: np.ndarray) -> Iterator[pa.RecordBatch]:
    seed, stretch, row, at, low, high = np.concatenate(found, axis=1)
    order = np.lexsort((at, ids[row], stretch))
    seed, stretch, row, at, low, high = (x[order] for x in (seed, stretch, row, at, low, high))
    head = np.ones(len(order), dtype=bool)
    head[1:] = (stretch[1:] != stretch[:-1]) | (seed[1:] != seed[:-1])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    # Equal to the earliest and not at the very same place.
    repeat = (ids[row] != ids[row[lead]]) | (at != at[lead])
    stays = ~repeat
    n = int(stays.sum())
    yield _batch(_ANCHOR_NAMES, _ANCHORS, np.zeros(n), seed[stays], stretch[stays], ids[row[stays]], ties[row[stays]], at[stays], low[stays], high[stays])
    r, start, end = _merged(row[repeat], at[repeat] - low[repeat], at[repeat] - low[repeat] + high[repeat] + LENGTH)
    if len(r):
        spread = bytetext.mix((r * 1_000_003 + start).astype(np.uint64)).view(np.int64)
        zero = np.zeros(len(r))
        yield _batch(_ANCHOR_NAMES, _ANCHORS, zero + 1, spread, end, ids[r], ties[r], start, zero, zero)


_KINDS = {"int": pa.int32(), "bigint": pa.int64()}


def _batch(names: list[str], ddl: str, *columns: np.ndarray) -> pa.RecordBatch:
    kinds = [_KINDS[x.split()[1]] for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)).cast(k) for c, k in zip(columns, kinds)], names=names)


_OPEN = "array<struct<at:bigint,low:int,high:int,sides:int>>"


def _half_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rank of the bytes on each side of the open anchors of ``id, tie, text, open``: ``id, tie, at, low, high, side, rank``."""
    for batch, block, prefix, row, at, low, high, _ in _open_anchors(batches):
        base = block.bounds[row]
        where = base + at
        for side, a, b, use in (
            (1, where, where + SEED + REACH, low - high <= REACH),
            (2, where - REACH, where + SEED, low >= REACH),
        ):
            use = use & (a >= base) & (b <= block.bounds[row + 1])
            if use.any():
                rank = bytetext.mix(bytetext.span_hash(prefix, a[use], b[use])).view(np.int64)
                r = block.first + row[use]
                yield _batch(_HALF_NAMES, _HALVES, batch[0][r], batch[1][r], at[use], low[use], high[use], np.full(int(use.sum()), side), rank)


_HALVES = "id bigint, tie bigint, at bigint, low int, high int, side int, rank bigint"
_HALF_NAMES = [x.split()[0] for x in _HALVES.split(", ")]
_POSITIONS = "part int, front bigint, back bigint, id bigint, tie bigint, start bigint, end bigint"
_POSITION_NAMES = [x.split()[0] for x in _POSITIONS.split(", ")]


def _open_anchors(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        opens = batch.column(3)
        for block in bytetext.blocks(batch.column(2)):
            part = opens.slice(block.first, block.rows)
            flat = part.flatten()
            if not len(flat):
                continue
            row = np.repeat(np.arange(block.rows), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            at, low, high, sides = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            yield (ids, ties), block, bytetext.prefix_hash(block.data), row, at, low, high, sides


def _window_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the open anchors that its sides leave open, with the ranks of its first and last ``HALF`` bytes (part 0).

    Of the windows that a task holds at a time, only the earliest of equal ranks is ranked further; the others are intervals (part 1).
    """
    found: list[np.ndarray] = []
    for batch, block, prefix, row, at, low, high, sides in _open_anchors(batches):
        for cut in range(0, len(row), 20_000):
            own = slice(cut, cut + 20_000)
            count = high[own] + 1
            which = np.repeat(np.arange(len(count)), count)
            step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            left = low[own][which] - step  # bytes of the window before its anchor
            s = sides[own][which]
            use = ((left <= REACH) & (s & 1 > 0)) | ((left >= REACH) & (s & 2 > 0))
            which, left = which[use], left[use]
            r = row[own][which]
            start = at[own][which] - left
            p = block.bounds[r] + start
            front = bytetext.mix(bytetext.span_hash(prefix, p, p + HALF)).view(np.int64)
            back = bytetext.mix(bytetext.span_hash(prefix, p + LENGTH - HALF, p + LENGTH)).view(np.int64)
            r = block.first + r
            found.append(np.stack([front, back, batch[0][r], batch[1][r], start]))
            if sum(x.shape[1] for x in found) > 400_000:
                yield from _reduced_windows(found)
                found = []
    if found:
        yield from _reduced_windows(found)


def _reduced_windows(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    front, back, ids, ties, start = np.concatenate(found, axis=1)
    order = np.lexsort((start, ids, back, front))
    front, back, ids, ties, start = (x[order] for x in (front, back, ids, ties, start))
    head = np.ones(len(order), dtype=bool)
    head[1:] = (front[1:] != front[:-1]) | (back[1:] != back[:-1])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    repeat = (ids != ids[lead]) | (start != start[lead])
    stays = ~repeat
    yield _batch(_POSITION_NAMES, _POSITIONS, np.zeros(int(stays.sum())), front[stays], back[stays], ids[stays], ties[stays], start[stays], start[stays] + LENGTH)
    if repeat.any():
        texts, row = np.unique(np.stack([ids[repeat], ties[repeat]]), axis=1, return_inverse=True)
        row, first, last = _merged(row.reshape(-1), start[repeat], start[repeat] + LENGTH)
        spread = bytetext.mix((row * 1_000_003 + first).astype(np.uint64)).view(np.int64)
        zero = np.zeros(len(row))
        yield _batch(_POSITION_NAMES, _POSITIONS, zero + 1, spread, zero, texts[0][row], texts[1][row], first, last)


def _cuts(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    """Result rows of ``id, tie, text, spans``."""
    for batch in batches:
        spans = batch.column(3)
        for block in bytetext.blocks(batch.column(2)):
            part = spans.slice(block.first, block.rows)
            flat = part.flatten()
            row = np.repeat(np.arange(block.rows), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            start, end = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1)) if len(flat) else (np.zeros(0, np.int64),) * 2
            row, start, end = _merged(row, start, end)
            removed = np.bincount(row, weights=end - start, minlength=block.rows).astype(np.int64)
            number = np.bincount(row, minlength=block.rows)
            first = np.searchsorted(row, np.arange(block.rows + 1))
            digests, kept = [], []
            for i in range(block.rows):
                a, b = block.bounds[i], block.bounds[i + 1]
                left, last = [], a
                for k in range(first[i], first[i + 1]):
                    left.append(block.data[last : a + start[k]].tobytes())
                    last = a + end[k]
                rest = b"".join([*left, block.data[last:b].tobytes()])
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            rows = slice(block.first, block.first + block.rows)
            columns = [batch.column(0)[rows], batch.column(1)[rows], pa.array(np.diff(block.bounds)), pa.array(removed), pa.array(number.astype(np.int64)), pa.array(digests)]
            names = ["id", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array([x.decode("utf-8", "replace") for x in kept], type=pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _place() -> Column:
    return F.struct("id", "at")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """``id, tie, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept_text``), one row for each row of ``docs``.

    ``kept_text`` is what is left, decoded; a cut inside a character leaves a replacement mark there.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie"), F.col(text).alias("text"))

    # Ranks 1 and 2. A task has reduced what it holds, so a seed has at most one row per batch and stretch.
    by_seed, by_stretch = Window.partitionBy("seed"), Window.partitionBy("seed", "stretch")
    ranked = (
        rows.mapInArrow(_anchors, _ANCHORS).repartition("seed").sortWithinPartitions("seed", "stretch", "id", "at")
        .withColumn("n", F.count(F.lit(1)).over(by_seed)).where("n > 1 or part = 1")
        .withColumn("least", F.min("stretch").over(by_seed)).withColumn("most", F.max("stretch").over(by_seed))
        .withColumn("first", F.first(_place()).over(by_stretch.orderBy("id", "at")))
    )
    path = scratch_folder(spark, "repeats-anchors")
    later = _place() > F.col("first")
    state = F.when((F.col("part") == 1) | later, F.lit(1)).otherwise(F.when(F.col("least") < F.col("most"), F.lit(0)))
    start = F.when(F.col("part") == 1, F.col("at")).otherwise(F.col("at") - F.col("low"))
    end = F.when(F.col("part") == 1, F.col("stretch")).otherwise(F.col("at") - F.col("low") + F.col("high") + LENGTH)
    ranked.withColumn("state", state).where("state is not null").select(
        "state", "id", "tie", "at", "low", "high", start.alias("start"), end.alias("end")
    ).write.partitionBy("state").parquet(path)
    schema = "id bigint, tie bigint, at bigint, low int, high int, start bigint, end bigint, state int"
    marked = spark.read.schema(schema).parquet(path)
    open_anchors = marked.where("state = 0").select("id", "tie", "at", "low", "high")

    # Rank 3. Equal rows give equal ranks, which changes nothing here.
    halves = _beside(rows, open_anchors.withColumn("sides", F.lit(3)), _half_ranks, _HALVES)
    seen = halves.groupBy("side", "rank").agg(F.min(_place()).alias("low_place"), F.max(_place()).alias("high_place")).where("low_place < high_place").select("side", "rank")
    sided = halves.join(seen, ["side", "rank"]).groupBy("id", "tie", "at", "low", "high").agg(F.bit_or("side").cast("int").alias("sides"))

    # Rank 4.
    by_rank = Window.partitionBy("front", "back").orderBy("id", "start")
    windows = _beside(rows, sided, _window_ranks, _POSITIONS).repartition("front").sortWithinPartitions("front", "back", "id", "start")
    windows = windows.withColumn("first", F.first(F.struct("id", "start")).over(by_rank))
    again = windows.where((F.col("part") == 1) | (F.struct("id", "start") > F.col("first"))).select("id", "tie", "start", "end")

    spans = marked.where("state = 1").select("id", "tie", "start", "end").union(again)
    per_text = spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(per_text, ["id", "tie"], "left").select("id", "tie", "text", "spans")
    ddl = "id bigint, tie bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept_text string" if keep_text else "")
    out = joined.mapInArrow(lambda batches: _cuts(batches, keep_text), ddl)
    return out.withColumn("id", F.when(F.col("id") != _NO_ID, F.col("id")))


def _beside(rows: DataFrame, anchors: DataFrame, scan, ddl: str) -> DataFrame:
    """``scan`` over the texts that have anchors, with these as a list."""
    lists = anchors.groupBy("id", "tie").agg(F.collect_list(F.struct("at", F.col("low").cast("int"), F.col("high").cast("int"), "sides")).cast(_OPEN).alias("open"))
    return rows.join(lists, ["id", "tie"]).select("id", "tie", "text", "open").mapInArrow(scan, ddl)

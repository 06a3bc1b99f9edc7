"""Benchmark decontamination with a broadcast set of n-gram hashes.

The benchmark's windows of ``words`` normalised words are hashed into a set. It is broadcast when it has at most
``MAX_WINDOWS`` windows (one row of 8 bytes of hash and the window's words each), which is counted first; a larger set is joined by hash
instead, with the same result; the texts then go through the join once, to place the spans. Each task scans its texts in blocks: all window hashes at once, a filter of one bit per hash
slot, the set, and then a comparison of the words themselves, so a hit is never a chance of the hash.

An item of fewer than ``words`` words, but not none, is one window of its own length.

Defined results: NULL and empty texts have no words and no hits; NULL and empty items have no window; repeated items
count once; NULL item ids hit words but are not listed. Repeated rows are scanned alike. Further columns are ignored by ``hits`` and kept by ``cleaned``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import bytetext

WORDS = 10
MAX_WINDOWS = 200_000
_FILTER_BITS = 22

# Words of the normalised text (after lower-casing A to Z).
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The words of ``text`` as an array."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD_PATTERN), F.lit(0))


def benchmark_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """Distinct ``gram`` (words joined by blanks), ``n`` (its number of words) and ``items`` (ids as strings)."""
    items = benchmark.select(F.col(key).cast("string").alias("item"), normalised(F.col(text)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(words))
    starts = items.select("item", "w", length.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("i"))
    return (
        starts.select("item", "n", F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("gram"))
        .groupBy("gram", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


class _Set:
    """Window hashes by length, with the windows and items of each."""

    def __init__(self, windows: list[tuple[str, int, list[str]]]):
        self.items = {gram.encode(): items for gram, _, items in windows}
        by_length = defaultdict(list)
        for gram, n, _ in windows:
            by_length[n].append(gram)
        self.hashes = {}
        for n, grams in by_length.items():
            found = []
            for block in bytetext.blocks(pa.array(grams, type=pa.large_string())):
                words = bytetext.words(block, bytetext.ALPHANUMERIC)
                found.append(bytetext.sequences(words.hash, n)[np.searchsorted(words.row, np.arange(block.rows))])
            self.hashes[n] = np.unique(np.concatenate(found))
        self.slots = {}
        for n, hashes in self.hashes.items():
            slots = np.zeros(1 << _FILTER_BITS, dtype=bool)
            slots[(hashes >> bytetext.U64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.slots[n] = slots


def _places(block: bytetext.Block, words: bytetext.Words, grams: _Set) -> Iterator[tuple[int, int, bytes]]:
    """First word, length and gram of each verified window of a block."""
    data = bytetext.LOWER[block.data]
    for n, hashes in grams.hashes.items():
        runs = bytetext.sequences(words.hash, n)
        maybe = np.flatnonzero(grams.slots[n][(runs >> bytetext.U64(64 - _FILTER_BITS)).astype(np.int64)])
        maybe = maybe[words.row[maybe] == words.row[maybe + n - 1]]
        at = np.minimum(np.searchsorted(hashes, runs[maybe]), len(hashes) - 1)
        for i in maybe[hashes[at] == runs[maybe]]:
            gram = b" ".join(data[a:b].tobytes() for a, b in zip(words.start[i : i + n], words.end[i : i + n]))
            if gram in grams.items:
                yield int(i), n, gram


def _spans(block: bytetext.Block, words: bytetext.Words, hit: np.ndarray) -> dict[int, list[list[int]]]:
    """Byte spans of the runs of hit words, by row of a block."""
    spans = defaultdict(list)
    for i in np.flatnonzero(hit):
        row = int(words.row[i])
        a, b = int(words.start[i] - block.bounds[row]), int(words.end[i] - block.bounds[row])
        if spans[row] and i and hit[i - 1] and words.row[i - 1] == row:
            spans[row][-1][1] = b
        else:
            spans[row].append([a, b])
    return spans


def _scan(batches: Iterator[pa.RecordBatch], shared, kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds number of words, hit words, items and the byte spans of hit runs to each row. The text is the last column."""
    grams = _Set(shared.value)
    for batch in batches:
        for block in bytetext.blocks(batch.column(batch.num_columns - 1)):
            words = bytetext.words(block, bytetext.ALPHANUMERIC)
            first = np.searchsorted(words.row, np.arange(block.rows + 1))
            covered = np.zeros(len(words.row) + 1, dtype=np.int64)
            items = defaultdict(set)
            for i, n, gram in _places(block, words, grams):
                covered[i] += 1
                covered[i + n] -= 1
                items[int(words.row[i])].update(x for x in grams.items[gram] if x is not None)
            hit = np.cumsum(covered[:-1]) > 0
            spans = _spans(block, words, hit)
            n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), first[:-1]) if block.rows else np.zeros(0, dtype=np.int64)
            n_hit[first[:-1] == first[1:]] = 0
            part = batch.slice(block.first, block.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:-1],
                    pa.array(np.diff(first)),
                    pa.array(n_hit),
                    pa.array([sorted(items.get(i, ())) for i in range(block.rows)], type=pa.list_(pa.string())),
                    pa.array([spans.get(i, ()) for i in range(block.rows)], type=pa.list_(pa.list_(pa.int64()))),
                ],
                schema=kind,
            )


def _placed(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Replaces the numbers of the hit words and the text, the last two columns, by the byte spans of hit runs."""
    for batch in batches:
        for block in bytetext.blocks(batch.column(batch.num_columns - 1)):
            words = bytetext.words(block, bytetext.ALPHANUMERIC)
            part = batch.slice(block.first, block.rows)
            hit = np.zeros(len(words.row), dtype=bool)
            for row, found in enumerate(part.column(part.num_columns - 2).to_pylist()):
                if found:
                    hit[np.searchsorted(words.row, row) + np.array(found)] = True
            spans = _spans(block, words, hit)
            added = pa.array([spans.get(i, ()) for i in range(block.rows)], type=pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*part.columns[:-2], added], schema=kind)


_ADDED = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))]
_ADDED_DDL = "n_words bigint, n_hit bigint, items array<string>, spans array<array<bigint>>"


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``id, tie, n_words, n_hit, items, spans``; spans are byte ranges of runs of hit words, ``tie`` a hash of the text."""
    windows = benchmark_windows(benchmark, item_key, item_text, words)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    if windows.count() > max_windows:
        return _joined_hits(rows, windows, words)
    grams = [(r["gram"], r["n"], list(r["items"])) for r in windows.collect()]
    shared = docs.sparkSession.sparkContext.broadcast(grams)
    kind = pa.schema([("id", pa.int64()), ("tie", pa.int64()), *_ADDED])
    return rows.mapInArrow(lambda batches: _scan(batches, shared, kind), f"id bigint, tie bigint, {_ADDED_DDL}")


def _joined_hits(rows: DataFrame, windows: DataFrame, words: int) -> DataFrame:
    """The same by joins, for benchmarks too large to send to every task. Only rows with a hit are grouped."""
    lengths = [r["n"] for r in windows.select("n").distinct().collect()]  # at most ``words`` numbers
    docs = rows.withColumn("w", normalised(F.col("text")))
    runs = None
    for n in lengths:
        at = docs.where(F.size("w") >= n).select("id", "tie", "w", F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i"))
        part = at.select("id", "tie", (F.col("i") - 1).alias("i"), F.lit(n).alias("n"), F.array_join(F.slice("w", F.col("i"), n), " ").alias("gram"))
        runs = part if runs is None else runs.union(part)
    found = runs.distinct().join(windows.select("gram", "n", "items"), ["gram", "n"])
    hit = found.select("id", "tie", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("n") - 1)).alias("j")).distinct()
    counts = hit.groupBy("id", "tie").agg(F.count(F.lit(1)).alias("h"), F.collect_list(F.col("j").cast("bigint")).alias("hit"))
    names = found.select("id", "tie", F.explode("items").alias("item")).groupBy("id", "tie").agg(F.sort_array(F.collect_set("item")).alias("names"))
    got = _null_safe(counts, names)
    sized = docs.select("id", "tie", F.size("w").cast("bigint").alias("n_words"), "text")
    out = _null_safe(sized, got)
    empty = F.array().cast("array<string>")
    counted = out.select("id", "tie", "n_words", F.coalesce("h", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("names", empty).alias("items"), "hit", "text")
    kind = pa.schema([("id", pa.int64()), ("tie", pa.int64()), *_ADDED])
    return counted.mapInArrow(lambda batches: _placed(batches, kind), f"id bigint, tie bigint, {_ADDED_DDL}")


def _null_safe(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnsRenamed({"id": "_id", "tie": "_tie"})
    return left.join(other, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left").drop("_id", "_tie")


def cleaned(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` without a hit, columns unchanged."""
    bad = hits(docs, benchmark, key, text, **options).where("n_hit > 0").select(F.col("id").alias("_id"), F.col("tie").alias("_tie")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left_anti").select("row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the runs of hit words cut out of the text, columns unchanged."""
    found = hits(docs, benchmark, key, text, **options).where("n_hit > 0").select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), "spans")
    found = found.dropDuplicates(["_id", "_tie"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"))
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    raw = F.col("row")[text].cast("binary")
    bounds = F.concat(F.array(F.lit(0).cast("bigint")), F.flatten("spans"), F.array(F.octet_length(raw).cast("bigint")))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda i: F.substring(raw, F.get(bounds, 2 * i) + 1, F.get(bounds, 2 * i + 1) - F.get(bounds, 2 * i)).cast("string"),
    )
    cut = F.when(F.col("spans").isNull(), F.col("row")[text]).otherwise(F.concat_ws("", pieces))
    names = [F.col("row")[c].alias(c) if c != text else cut.alias(c) for c in docs.columns]
    return joined.select(*names)

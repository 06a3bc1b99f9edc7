"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are counted as NumPy passes over its bytes. Each feature is cut into quantile bins. Training goes
round the features again and again; each time a shallow tree (at most ``LEAVES`` leaves) is fitted to the gradient of the
logistic loss on one feature's bins, and a small step of it is added to that feature's lookup table. Pairs that explain the rest
best then get tables of their own, by trees of one cut on each axis. A score is the logistic of the sum of the looked-up
values, for a batch at a time.

The model is fitted on the driver from at most ``MAX_ROWS`` labelled rows (those with the least hash of the id); everything else
runs in tasks over all rows.

Defined results: NULL and empty texts have all features 0 and are scored like any other. Without any labelled row, or with one
class only, the score is that class's smoothed share. Rows of a repeated id all count in training; repeated rows are
scored alike. A NULL id has no label. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import bytetext
from corpusmill.llm.quality_rules import STOP_WORDS

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 80
PAIR_ROUNDS = 30
LEAVES = 4
RATE = 0.15
MIN_LEAF = 5

FEATURES = (
    "log_words", "log_bytes", "word_bytes", "symbols", "exclamations", "capitals", "digits", "stops", "commas", "lines", "distinct_words",
    "adjacent_repeats", "distinct_runs", "beyond_ascii", "stop_words", "short_words", "repeated_lines",
)
_LINE = ~bytetext.byte_class(b"\n", False)


def _stop_hashes() -> np.ndarray:
    block = next(bytetext.blocks(pa.array(STOP_WORDS, type=pa.large_string())))
    return np.sort(bytetext.words(block, bytetext.SPACED).hash)


def features(block: bytetext.Block) -> np.ndarray:
    """One row of ``FEATURES`` for each row of the block."""
    n, bounds = block.rows, block.bounds
    words = bytetext.words(block, bytetext.SPACED)
    first = np.searchsorted(words.row, np.arange(n + 1))
    n_words, n_bytes = np.diff(first), np.diff(bounds)

    def chars(kind: bytes) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(bytetext.byte_class(kind, False)[block.data])])
        return np.diff(total[bounds])

    def each(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])

    per_word, per_byte = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    capitals, letters = chars(bytes(range(65, 91))), chars(bytes(range(97, 123)))
    same = np.zeros(len(words.row), dtype=bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    runs = bytetext.sequences(words.hash, 5)
    lines = bytetext.words(block, _LINE)
    line_first = np.searchsorted(lines.row, np.arange(n + 1))
    distinct = np.ones((n, 3))
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b > a:
            distinct[i, 0] = len(np.unique(words.hash[a:b])) / (b - a)
            distinct[i, 2] = len(np.unique(lines.hash[line_first[i] : line_first[i + 1]])) / (line_first[i + 1] - line_first[i])
        if b - a >= 5:
            distinct[i, 1] = len(np.unique(runs[a : b - 4])) / (b - a - 4)
    ends = block.data[words.end - 1] if len(words.end) else np.zeros(0, dtype=np.uint8)
    stops = _stop_hashes()
    at = np.minimum(np.searchsorted(stops, words.hash), len(stops) - 1)
    return np.column_stack([
        np.log1p(n_words),
        np.log1p(n_bytes),
        each(words.end - words.start) / per_word,
        chars(b"#*$%&|<>{}[]\\~^_=") / per_word,
        chars(b"!?") / per_word,
        capitals / np.maximum(capitals + letters, 1),
        chars(b"0123456789") / per_byte,
        each(ends == ord(".")) / per_word,
        each(ends == ord(",")) / per_word,
        chars(b"\n") / per_word,
        distinct[:, 0],
        each(same) / per_word,
        distinct[:, 1],
        np.diff(np.concatenate([[0], np.cumsum(block.data >= 128)])[bounds]) / per_byte,
        each(stops[at] == words.hash) / per_word,
        each(words.end - words.start <= 2) / per_word,
        1 - distinct[:, 2],
    ])


def _best_cuts(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Step of each bin of a tree with at most ``leaves`` leaves on the bins' gradients and weights."""
    groups = [(0, len(g))]
    value = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1.0)
    while len(groups) < leaves:
        best = (1e-9, None, None)
        for a, b in groups:
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gr, hr = g[a:b].sum() - gl, h[a:b].sum() - hl
            gain = gl**2 / (hl + 1.0) + gr**2 / (hr + 1.0) - value(a, b)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        groups.remove(best[1])
        groups += [(best[1][0], best[2]), (best[2], best[1][1])]
    step = np.zeros(len(g))
    for a, b in groups:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return step


def _best_quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree with one cut on each axis, for tables of gradients and weights."""
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts_g = [G[:-1, :-1], G[:-1, -1:] - G[:-1, :-1], G[-1:, :-1] - G[:-1, :-1], G[-1, -1] - G[:-1, -1:] - G[-1:, :-1] + G[:-1, :-1]]
    parts_h = [H[:-1, :-1], H[:-1, -1:] - H[:-1, :-1], H[-1:, :-1] - H[:-1, :-1], H[-1, -1] - H[:-1, -1:] - H[-1:, :-1] + H[:-1, :-1]]
    gain = sum(a**2 / (b + 1.0) for a, b in zip(parts_g, parts_h))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [a[i, j] / (b[i, j] + 1.0) for a, b in zip(parts_g, parts_h)]
    step = np.empty(g.shape)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = value
    return float(gain[i, j]), step


@dataclass
class Model:
    """Cut points and table of each feature, pairs with their coarse cut points and tables."""

    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[f], x[:, f], side="right")]
        coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.pair_cuts)]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def _quantiles(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS) -> Model:
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Model(start, [], [], [], [], [])
    n = x.shape[1]
    cuts = [_quantiles(x[:, f], BINS) for f in range(n)]
    bins = [np.searchsorted(cuts[f], x[:, f], side="right") for f in range(n)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), start)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f in range(n):
            g, h = gradients()
            size = len(tables[f])
            step = RATE * _best_cuts(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size), LEAVES)
            tables[f] += step
            total += step[bins[f]]

    pair_cuts = [_quantiles(x[:, f], PAIR_BINS) for f in range(n)]
    coarse = [np.searchsorted(pair_cuts[f], x[:, f], side="right") for f in range(n)]

    def table_of(a: int, b: int, w: np.ndarray) -> np.ndarray:
        shape = (len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)
        return np.bincount(coarse[a] * shape[1] + coarse[b], w, shape[0] * shape[1]).reshape(shape)

    wide = [f for f in range(n) if len(pair_cuts[f])]
    g, h = gradients()
    ranked = sorted(((_best_quadrants(table_of(a, b, g), table_of(a, b, h))[0], a, b) for i, a in enumerate(wide) for b in wide[i + 1 :]), reverse=True)
    chosen = [(a, b) for _, a, b in ranked[:pairs]]
    pair_tables = [np.zeros((len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)) for a, b in chosen]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(chosen):
            g, h = gradients()
            step = RATE * _best_quadrants(table_of(a, b, g), table_of(a, b, h))[1]
            pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return Model(start, cuts, tables, chosen, pair_cuts, pair_tables)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in bytetext.blocks(batch.column(1)):
            x = features(block)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0)[block.first : block.first + block.rows], lists], names=["label", "features"])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Model from the documents that ``labels`` marks (1 good, 0 not). Pass only the rows that may be learnt from."""
    marked = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("label")).where("_id is not null and label in (0, 1)")
    chosen = F.broadcast(marked.orderBy(F.xxhash64("_id"), "_id", "label").limit(max_rows))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(chosen, "_id").select("label", "text")
    sample = rows.mapInArrow(_measured, "label int, features array<double>").orderBy(F.xxhash64("features"), "label").limit(max_rows).collect()
    x = np.array([r["features"] for r in sample], dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["label"] for r in sample], dtype=np.float64))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in bytetext.blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.first : block.first + block.rows], pa.array(model.score(features(block)))], names=["id", "score"])

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(score, "id bigint, score double")

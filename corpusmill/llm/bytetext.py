"""Words and rolling hashes of many texts at once, as NumPy passes over their UTF-8 bytes.

Texts are taken from Arrow columns in blocks of a few megabytes, so memory does not depend on the batch
size; a single text longer than that is a block of its own. Words are runs of bytes of a class; in UTF-8 the bytes of
non-ASCII characters never fall into an ASCII class, so byte classes and character classes agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

U64 = np.uint64
# Odd multipliers and the finaliser of splitmix64.
_BASE = 0x9E3779B97F4A7C15 | 1
_CHAIN = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(_CHAIN))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least ``n`` of them; kept for blocks of the usual size."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        size = max(n, BLOCK_BYTES + 1)
        kept = np.full(size, base, dtype=U64)
        kept[0] = 1
        np.cumprod(kept, out=kept)
        if size == BLOCK_BYTES + 1:
            _POWERS[base] = kept
    return kept[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``out[j] - out[i]`` is the hash of bytes i..j times base**i."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_byte_values()[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span; equal spans of bytes have equal hashes wherever they lie."""
    return (prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start]


def window_hash(prefix: np.ndarray, size: int, n: int) -> np.ndarray:
    """Hash of the window of ``size`` bytes at each of the first ``n`` positions."""
    return (prefix[size : size + n] - prefix[:n]) * powers(_INVERSE, len(prefix))[:n]


@dataclass
class Block:
    """Consecutive rows of a column: their bytes one after the other, and each row's bounds."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """``column`` in blocks of at most ``limit`` bytes, or of one longer row. NULL counts as empty."""
    if len(column) == 0:
        return
    at, data = _buffers(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield Block(first, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def byte_class(chars: bytes, above_ascii: bool) -> np.ndarray:
    """Table of 256 booleans: the given ASCII bytes, and all bytes from 0x80 on demand."""
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    out[128:] = above_ascii
    return out


def _lowered() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


LOWER = _lowered()
# White space of words between blanks; letters and digits of alphanumeric words.
SPACED = ~byte_class(b"\x20\x09\x0a\x0b\x0c\x0d", False)
ALPHANUMERIC = byte_class(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)), True)


@dataclass
class Words:
    """Words of a block: bounds in its bytes, row of each, and a hash of each."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


def words(block: Block, kind: np.ndarray) -> Words:
    """Words of the lower-cased (A to Z) texts; ``kind`` is the table of word bytes."""
    data = LOWER[block.data]
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[block.bounds] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    row = np.searchsorted(block.bounds, start, side="right") - 1
    return Words(start, end, row, mix(span_hash(prefix_hash(data), start, end)))


def sequences(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.full(n, size, dtype=U64)
    for j in range(size):
        out = out * U64(_CHAIN) + hashes[j : j + n]
    return mix(out)


def shingle_sets(block: Block, size: int, kind: np.ndarray = SPACED) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row: of all runs of ``size`` words, or of the whole sequence if it is shorter."""
    found = words(block, kind)
    first = np.searchsorted(found.row, np.arange(block.rows + 1))
    runs = sequences(found.hash, size)
    out = []
    for i in range(block.rows):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            out.append(sequences(found.hash[a:b], b - a))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out

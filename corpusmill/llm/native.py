"""Column helpers for the operators that stay in Spark's own functions.

A lambda of a higher-order function evaluates what it refers to once per element, so a value used inside
a lambda must be bound first: ``let`` does that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64
PIECE = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def occurrences(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are one of ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _scan(numbers: Column, start: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``merge`` over a short array, after ``start``."""
    begin = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, x: F.struct(merge(acc["at"], x).alias("at"), F.array_append(acc["out"], merge(acc["at"], x)).alias("out"))
    return F.aggregate(numbers, begin, step)["out"]


def running(numbers: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``merge`` (0 is neutral, order of merging does not matter) over an ``array<int>``.

    An array that grows by appending is copied for each element, so a long one is scanned in blocks: first the results
    of whole blocks, then each block after that of the blocks before it.
    """
    def blocks(parts: Column) -> Column:
        whole = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), merge))
        after = lambda ends: F.transform(parts, lambda p, b: _scan(p, F.coalesce(F.get(ends, b - 1), F.lit(0)), merge))
        return let(_scan(whole, F.lit(0), merge), lambda ends: F.flatten(after(ends)))

    def of(x: Column) -> Column:
        n = F.size(x)
        block = lambda b: F.transform(F.sequence(b * BLOCK, F.least(n, (b + 1) * BLOCK) - 1), lambda i: F.get(x, i))
        last = F.floor((n - 1) / BLOCK).cast("int")
        return F.when(n <= BLOCK, _scan(x, F.lit(0), merge)).otherwise(let(F.transform(F.sequence(F.lit(0), last), block), blocks))

    return let(numbers, of)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, value>>``.

    ``pattern`` must not match the empty string. Positions are code points from 0, ends exclusive. ``split`` gives
    the gaps between the very matches that ``regexp_extract_all`` gives, so positions are running lengths.
    """
    def located(values: Column, gaps: Column) -> Column:
        sizes = F.transform(values, lambda v, i: F.length(F.get(gaps, i)) + F.length(v))
        at = lambda ends: F.transform(
            values, lambda v, i: F.struct((F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value"))
        )
        return let(running(sizes, lambda a, b: a + b), at)

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda values: F.when(F.size(values) == 0, empty).otherwise(let(F.split(text, pattern, -1), lambda gaps: located(values, gaps))),
    )


def pieces(text: Column) -> Column:
    """``text`` in pieces of ``PIECE`` characters, for ``part``: a substring of a long text walks over all before it."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(pieces: Column, start: Column, size: Column) -> Column:
    """``size`` characters from ``start`` (from 0), or as many as there are; bind ``start`` and ``size`` when they are costly."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((start + size - 1) / PIECE).cast("int")
    held = F.array_join(F.transform(F.sequence(first, last), lambda k: F.get(pieces, k)), "")
    return F.when(size <= 0, F.lit("")).otherwise(F.substring(held, start - first * PIECE + 1, size))

"""Spans of a text as arrays of ``struct<start, rank, end, kind>``: kept in order, printed, tested for overlap, replaced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.llm.native import let, matches, part, pieces, running

TYPE = "array<struct<start:int,rank:int,end:int,kind:string>>"


def none() -> Column:
    return F.array().cast(TYPE)


def labelled(found: Column, kind: str, rank: int) -> Column:
    """Matches as spans of one kind; ``rank`` orders kinds that start together."""
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def found(text: Column, pattern: str, kind: str, rank: int, keep=None, when: Column | None = None) -> Column:
    """Spans of the matches of ``pattern`` whose value passes ``keep``; ``when`` is a cheap test that the text can have any."""
    all_of = matches(text, pattern)
    out = labelled(all_of if keep is None else F.filter(all_of, lambda m: keep(m["value"])), kind, rank)
    return out if when is None else F.when(when, out).otherwise(none())


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def printed(spans: Column) -> Column:
    """``kind:start:end`` by start, then rank, joined by commas."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def shadow(spans: Column) -> Column:
    """What ``overlaps`` searches: starts in order, the furthest end up to each, and the steps of a binary search."""
    def of(s: Column) -> Column:
        steps = F.transform(F.sequence(F.lit(30), F.lit(0)), lambda k: F.pow(F.lit(2), k).cast("int"))
        return F.struct(
            F.transform(s, lambda x: x["start"]).alias("starts"),
            running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b)).alias("reach"),
            F.filter(steps, lambda k: k <= F.size(s)).alias("steps"),
        )

    return let(F.sort_array(spans), of)


def overlaps(span: Column, shade: Column) -> Column:
    """Whether ``span`` shares a character with a span of ``shade`` (a bound ``shadow``), by binary search."""
    step = lambda n, k: F.when((n + k <= F.size(shade["starts"])) & (F.get(shade["starts"], n + k - 1) < span["end"]), n + k).otherwise(n)
    before = F.aggregate(shade["steps"], F.lit(0), step)
    return F.coalesce(F.get(shade["reach"], before - 1) > span["start"], F.lit(False))


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with each maximal run of overlapping spans replaced by its first kind in brackets."""
    def of(s: Column, reach: Column, held: Column) -> Column:
        # A span opens a run when nothing before it reaches its start; the text between runs is kept.
        end = lambda i: F.coalesce(F.get(reach, i - 1), F.lit(0))
        fresh = lambda x, i: F.concat(part(held, end(i), x["start"] - end(i)), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        runs = F.transform(s, lambda x, i: F.when(x["start"] >= end(i), fresh(x, i)))
        last = F.get(reach, F.size(reach) - 1)
        return F.concat(F.array_join(runs, ""), part(held, last, F.length(text) - last))

    def ends(s: Column) -> Column:
        return running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b))

    whole = let(F.sort_array(spans), lambda s: let(ends(s), lambda reach: let(pieces(text), lambda held: of(s, reach, held))))
    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(whole)

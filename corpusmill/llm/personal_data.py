"""Personal data: checked formats, and candidates chosen by boosted trees.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by format and check. Wide generators then propose spans that may
overlap these and each other: number-like runs, written-out addresses, account numbers. Accounts that pass their remainder check are always added;
so are written-out addresses outside base spans that have the base format once normalised. A boosted tree ensemble decides on the
candidates left, by format and context (never by the outcome of a check). For each generator it is fitted on all its candidates in all
documents that could be added, outside base spans and what is added before; those with equal features and label are one kind with its number.
Positive are confirmed accounts and addresses, and numbers with a word for and none against personal data before them; the trees of numbers do not
see these words. Of all candidates, those in a third by hash are not fitted on; all of them set the least score at which ``PRECISION`` of the candidates are positive. Base spans always stay. Scoring is one projection of Spark
functions.

Defined results: NULL and empty texts have no spans, an empty table gives an empty result. Repeated rows are scanned alike. Patterns are written so that
they are linear on long runs; time grows with the length of a text and the number of its matches, not with their product. A generator with fewer than
``LEAST`` candidates in the third that is held out has no trees and no threshold.
Without positive candidates, only confirmed ones are added. A valid account number is added even where it overlaps a base span, so no part of it stays. ``redacted`` keeps a NULL text NULL and all columns of its input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import boosted_trees, spans
from corpusmill.llm.native import let, matches, part, pieces
from corpusmill.session import shared_folder

MAX_ROWS = 20_000  # kinds of candidates that are fitted on the driver; more are fitted by Spark jobs, with the same result
PRECISION = 0.95
LEAST = 30
KINDS = ("email", "ip", "card", "phone")

# The formats of the base. A look-behind or possessive repeat only saves attempts that fail.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?"
IP_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"

# The generators. A point with a blank only after it ends a sentence, not a part of an address.
GENERATORS = (
    ("account", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"),
    ("address", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]++(?:(?:\x20?\.|\x20\.\x20|\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?)[A-Za-z0-9-]++)++"),
    ("number", r"(?<![A-Za-z0-9.])[(+]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,22}(?![A-Za-z0-9])"),
)
# Written-out parts of an address, and the format of a whole one; the last part has letters, unlike a price after @.
WRITTEN_DOT, WRITTEN_AT = r"\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?", r"\x20?(?:@|\[at\]|\(at\))\x20?"
ADDRESS = r"^[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}$"
# Words before a span that speak for and against personal data.
CUES_FOR = r"(?i)(?:tel|phone|mobile|call|fax|contact|mail|card|visa|iban|account|ssn|passport|address|telefon|handy|konto|karte|téléphone|carte|compte|correo|teléfono|tarjeta|cuenta)"
CUES_AGAINST = r"(?i)(?:version|isbn|issn|invoice|order|page|figure|table|section|total|price|usd|eur|date|year|ref|doi)"
CONTEXT = 24


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def check(back: Column) -> Column:
        digit = lambda i: F.substring(back, i, F.lit(1)).cast("int")
        twice = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
        total = F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda s, i: s + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i)))
        return total % 10 == 0

    return let(F.reverse(digits), check)


def _account_holds(value: Column) -> Column:
    """Remainder check of account numbers: first four characters to the end, letters as 10 to 35, 1 modulo 97."""
    def check(s: Column) -> Column:
        code = lambda i: F.ascii(F.substring(s, i, F.lit(1)))
        step = lambda a, c: F.when(c >= 65, (a * 100 + c - 55) % 97).otherwise((a * 10 + c - 48) % 97)
        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), lambda a, i: step(a, code(i))) == 1

    plain = F.replace(value, F.lit(" "), F.lit(""))
    return let(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), check)


def _address_holds(value: Column) -> Column:
    """Base format of a written-out address after normalising; the bare word ``at`` counts where a dot is written out too."""
    bare = F.when(value.rlike(WRITTEN_DOT), F.regexp_replace(value, r"\x20at\x20", "@")).otherwise(value)
    marked = F.regexp_replace(F.regexp_replace(bare, WRITTEN_DOT, "."), WRITTEN_AT, "@")
    return F.regexp_replace(marked, r"\x20?\.\x20?", ".").rlike(ADDRESS)


CHECKS = {"account": _account_holds, "address": _address_holds}


def _is_card(value: Column) -> Column:
    return let(digits_of(value), lambda d: F.length(d).between(12, 19) & F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))


def base_spans(text: Column) -> Column:
    """All spans of the base kinds; ``text`` must not be NULL."""
    number = text.rlike("[0-9]")
    return F.concat(
        spans.found(text, EMAIL, "email", 0, when=F.contains(text, F.lit("@"))),
        F.when(
            number,
            F.concat(
                spans.found(text, IP, "ip", 1, keep=lambda v: v.rlike(IP_PARTS)),
                spans.found(text, CARD, "card", 2, keep=_is_card),
                spans.found(text, PHONE, "phone", 3, keep=lambda v: F.length(digits_of(v)).between(9, 15), when=F.contains(text, F.lit("+"))),
            ),
        ).otherwise(spans.none()),
    )


FEATURES = ("chars", "digits", "letters", "capitals", "spaces", "dots", "dashes", "brackets", "plus", "cue_for", "cue_against", "before", "after", "longest_group")


def _seen(held: Column, m: Column) -> Column:
    """A candidate's value and what surrounds it, from the ``pieces`` of the text."""
    left = F.greatest(m["start"] - CONTEXT, F.lit(0))
    return F.struct(m["value"].alias("value"), part(held, left, m["start"] - left).alias("before"), part(held, m["end"], F.lit(1)).alias("after"))


def _features(seen: Column) -> Column:
    """Integers of ``FEATURES`` for what ``_seen`` gives: a candidate's format and context."""
    value, before = seen["value"], seen["before"]
    n = lambda pattern: F.regexp_count(value, F.lit(pattern))
    groups = F.transform(F.split(value, "[^0-9]+"), lambda g: F.length(g))
    kind = lambda c: F.when(c == "", 0).when(c.rlike("^[A-Za-z]$"), 1).when(c.rlike(r"^\s$"), 2).when(c.rlike("^[:=#\"'(]$"), 3).otherwise(4)
    return F.array(
        F.length(value), n("[0-9]"), n("[A-Za-z]"), n("[A-Z]"), n(r"\x20"), n(r"\."), n("-"), n(r"[()\[\]]"), n(r"\+"),
        before.rlike(CUES_FOR).cast("int"), before.rlike(CUES_AGAINST).cast("int"),
        kind(F.right(before, F.lit(1))), kind(seen["after"]), F.array_max(groups),
    )


def _may_have(name: str, text: Column) -> Column:
    if name == "address":
        return text.rlike(r"@|[\[(](?:at|dot)[\])]|\x20dot\x20")
    return text.rlike("[0-9]{2}" if name == "account" else "[0-9]")


def _candidates(text: Column, name: str, pattern: str) -> Column:
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(_may_have(name, text), matches(text, pattern)).otherwise(empty)


@dataclass
class Chooser:
    """Of each generator, trees and the least score to be chosen."""

    models: dict[str, tuple[float, list[boosted_trees.Split]]]
    least: dict[str, float]


NAMES = [name for name, _ in GENERATORS]


def _located(rows: DataFrame) -> DataFrame:
    """``rows`` (with a text ``t``) and its base spans ``base`` and candidates, one column for each generator.

    Steps are projections of their own: as one expression they would be too deep to analyse.
    """
    t = F.col("t")
    return rows.select("*", base_spans(t).alias("base"), *[_candidates(t, name, pattern).alias(name) for name, pattern in GENERATORS])


def _open_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Candidates that overlap no base span and no confirmed candidate of a generator before theirs, found in one pass over the texts.

    ``g`` is the number of the generator, ``h`` a hash of document and candidate, ``seen`` what ``_seen`` gives.
    """
    c = {name: F.col(name) for name in NAMES}

    def free(found: Column, known: str) -> Column:
        return F.when(F.size(found) == 0, found).otherwise(let(spans.shadow(F.col(known)), lambda shade: F.filter(found, lambda m: ~spans.overlaps(m, shade))))

    def more(name: str, known: str) -> Column:
        return F.concat(known, spans.labelled(F.filter(c[name], lambda m: CHECKS[name](m["value"])), name, 0))

    def one(i: int, name: str) -> Column:
        return F.transform(c[name], lambda m: F.struct(F.lit(i).alias("g"), F.xxhash64("_id", m).alias("h"), _seen(F.col("held"), m).alias("seen")))

    rows = _located(docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("t")))
    rows = rows.select("*", more("account", "base").alias("known"))
    rows = rows.select("*", more("address", "known").alias("all_known"))
    rows = rows.select("_id", "t", *[free(c[name], known).alias(name) for name, known in zip(NAMES, ("base", "known", "all_known"))])
    some = sum((F.size(x) for x in c.values()), F.lit(0)) > 0
    rows = rows.select("_id", *NAMES, F.when(some, pieces(F.col("t"))).alias("held"))
    rows = rows.select(F.concat(*[one(i, name) for i, name in enumerate(NAMES)]).alias("c"))
    # An inner explode would get a filter on the size of its array, which is pushed down and computes everything twice.
    return rows.select(F.explode_outer("c").alias("c")).where("c is not null").select("c.g", "c.h", "c.seen")


def _kinds(docs: DataFrame, key: str, text: str) -> DataFrame:
    """All candidates that could be added, counted by generator ``g``, whether they are ``held`` out, label ``y`` and features ``x``."""
    rows = _open_rows(docs, key, text)
    value = F.col("seen.value")
    confirmed = F.when(F.col("g") == 0, _account_holds(value)).when(F.col("g") == 1, _address_holds(value)).otherwise(False)
    rows = rows.select("g", "h", confirmed.alias("confirmed"), _features(F.col("seen")).alias("x")).distinct()  # repeated rows are one
    cues = [FEATURES.index("cue_for"), FEATURES.index("cue_against")]
    cued = (F.get("x", F.lit(cues[0])) == 1) & (F.get("x", F.lit(cues[1])) == 0)
    learned = F.col("g").isin([i for i, name in enumerate(NAMES) if name not in CHECKS])
    unseen = F.transform("x", lambda v, i: F.when(i.isin(cues), 0).otherwise(v))  # what labels a number is not a feature of it
    rows = rows.select(
        "g", (F.col("h") % 3 == 0).alias("held"), F.when(learned, cued).otherwise(F.col("confirmed")).cast("int").alias("y"),
        F.when(learned, unseen).otherwise(F.col("x")).alias("x"),
    )
    return rows.groupBy("g", "held", "y", "x").agg(F.count("*").alias("n"))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> Chooser:
    """Trees and thresholds from all candidates; ``docs`` is read once, the kinds of candidates are checkpointed.

    A generator's kinds come to the driver when there are at most ``max_rows`` of them; trees and thresholds are the same with any ``max_rows``.
    """
    shared_folder(docs.sparkSession)
    kinds = _kinds(docs, key, text).checkpoint()
    totals = {(r["g"], r["held"]): r for r in kinds.groupBy("g", "held").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.max("y").alias("y")).collect()}
    models, least = {}, {}
    for i, name in enumerate(NAMES):
        out, held = totals.get((i, False)), totals.get((i, True))
        if not out or not held or held["n"] < LEAST or not held["y"] or not out["y"]:
            continue
        own = kinds.where(F.col("g") == i)
        if out["kinds"] + held["kinds"] <= max_rows:
            found = own.collect()
            x = boosted_trees.matrix([r["x"] for r in found], len(FEATURES))
            y, n = np.array([r["y"] for r in found], dtype=np.float64), np.array([r["n"] for r in found], dtype=np.int64)
            apart = np.array([r["held"] for r in found], dtype=bool)
            models[name] = boosted_trees.fit(x[~apart], y[~apart], n=n[~apart])
            cut = boosted_trees.calibrated(boosted_trees.margins(models[name], x[apart]), y[apart], PRECISION, LEAST, n[apart])
        else:
            models[name] = boosted_trees.fit_spread(own.where("not held"))
            cut = boosted_trees.calibrated_spread(own.where("held"), models[name], PRECISION, LEAST)
        if np.isfinite(cut):
            least[name] = cut
    return Chooser(models, least)


def _adder(chooser: Chooser, name: str, rank: int) -> Column:
    """``spans`` and the confirmed or chosen candidates of a generator that overlap none of them."""
    found, before, held = F.col(name), F.col("spans"), F.col("held")

    def chosen(m: Column, shade: Column) -> Column:
        over = F.lit(False)
        if name in chooser.least:
            score = lambda x: boosted_trees.expression(chooser.models[name], lambda i: F.get(x, F.lit(i)))
            over = let(let(_seen(held, m), _features), score) >= chooser.least[name]
        checked = CHECKS[name](m["value"]) if name in CHECKS else F.lit(False)
        if name == "account":
            return F.when(checked, True).when(spans.overlaps(m, shade), False).otherwise(over)
        return F.when(spans.overlaps(m, shade), False).when(checked, True).otherwise(over)

    more = let(spans.shadow(before), lambda shade: F.concat(before, spans.labelled(F.filter(found, lambda m: chosen(m, shade)), name, rank)))
    return F.when(F.size(found) == 0, before).otherwise(more)


def with_spans(docs: DataFrame, chooser: Chooser, text: str = "text") -> DataFrame:
    """``row`` (struct of the columns of ``docs``), ``base_spans``, ``spans``.

    To the base are added the confirmed accounts and addresses, and the chosen candidates that overlap nothing chosen before.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = _located(rows.select("row", F.coalesce(F.col("row")[text], F.lit("")).alias("t")))
    scored = sum((F.size(name) for name in chooser.least), F.lit(0)) > 0
    rows = rows.select("row", F.col("base").alias("base_spans"), F.col("base").alias("spans"), *NAMES, F.when(scored, pieces(F.col("t"))).alias("held"))
    for rank, name in enumerate(NAMES, start=len(KINDS)):
        if name in CHECKS or name in chooser.least:
            rows = rows.withColumn("spans", _adder(chooser, name, rank))
    return rows.select("row", "base_spans", "spans")


def redacted(docs: DataFrame, chooser: Chooser, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; a column ``n_chars`` gets the new length."""
    clean = with_spans(docs, chooser, text).withColumn("clean", spans.replaced(F.col("row")[text], F.col("spans")))
    values = {text: F.col("clean")}
    if n_chars in docs.columns:
        values[n_chars] = F.length("clean").cast(docs.schema[n_chars].dataType)
    return clean.select(*[values.get(c, F.col("row")[c]).alias(c) for c in docs.columns])

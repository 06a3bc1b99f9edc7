"""Secrets: fixed formats, and random-looking strings found by two character Markov models.

The base finds assignments, access keys and long hexadecimal strings. The method adds tokens that look drawn at random: the
log-likelihood ratio of a model of random strings and one of ordinary identifiers, summed over the token's pairs of characters.
Both models are counts of character pairs. Random strings are generated by hashing numbers (six alphabets, ``RANDOM_ROWS`` of
each); ordinary identifiers are the words and joined words of all documents, whose pairs are counted where they are read, so at most two
numbers per pair leave a task. Identifiers that the corpus does not write are added from the same counts: words in capitals, words joined by signs, by a
capital or by nothing but a number. A fifth of the weight goes to pairs of kinds of characters, so that names of another language or in
other words than the corpus has are no random strings. The table of ratios has one number per pair of printable ASCII characters and becomes a literal of the projection.

The threshold is fitted too: under the counts of ordinary identifiers the ratio of a pair has a mean and a deviation, and a token must
be ``DEVIATIONS`` above what as many pairs of ordinary identifiers sum up to, and in favour of a random string by ``LEAST_SUM``.

Defined results: NULL and empty texts have no spans. Repeated rows are scanned alike. A corpus without identifiers still has a model, by smoothing, and
an empty table gives an empty result. Further columns, whatever their names, are kept in ``row``. Time grows with the length of a text and the number of
its matches, not with their product.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import spans
from corpusmill.llm.native import let, matches

RANDOM_ROWS = 5_000
KINDS = ("assign", "access", "hex")
LEAST_SUM = 4.0  # log odds against a token being random before it is seen
DEVIATIONS = 4.0
# Shares of the words that are also counted in capitals, and as parts of longer names.
CAPITALS, JOINED = 0.1, 0.25
BACKOFF = 0.2  # weight of kinds of characters (lower case, capital, digit, sign) beside that of the characters themselves
_FIRST, _SIZE = 33, 94  # printable ASCII

# The formats of the base. Look-behinds only save attempts that fail.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
# An ordinary identifier, of words with at most a short number.
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z]+(?:[_-][A-Za-z]+)*+[0-9]{0,3}(?![A-Za-z0-9+/_=-])"


def base_spans(text: Column) -> Column:
    """All spans of the base kinds; ``text`` must not be NULL. An assignment's span is the whole match."""
    return F.concat(
        spans.found(
            text, ASSIGN, "assign", 0, keep=lambda v: F.length(F.regexp_extract(v, ASSIGN_VALUE, 1)) >= 6, when=text.rlike("[:=]"),
        ),
        spans.found(text, ACCESS, "access", 1, keep=lambda v: F.length(v) >= 20, when=F.contains(text, F.lit("AKIA"))),
        spans.found(text, HEX, "hex", 2, when=text.rlike("[0-9a-f]{24}")),
    )


def _pairs(strings: DataFrame) -> DataFrame:
    """``label, pair, n`` of ``label, s``."""
    each = strings.where(F.length("s") >= 2).select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))).alias("pair"))
    return each.groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n"))


def _random_strings(spark: SparkSession, rows: int) -> DataFrame:
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")).cast("binary"), 256)
    packed = F.base64(F.unhex(digest))
    letters = F.regexp_replace(packed, "[^A-Za-z0-9]", "")
    alphabets = F.array(F.substring(digest, 1, 40), packed, F.translate(packed, "+/", "-_"), letters, F.upper(letters), F.lower(letters))
    return spark.range(rows).select(F.lit(1).alias("label"), F.explode(alphabets).alias("s"))


@dataclass
class Model:
    """Log-likelihood ratio of each pair of printable characters, row by row; its mean and deviation in ordinary identifiers."""

    ratios: list[float]
    mean: float = 0.0
    deviation: float = 0.0


def _at(chars: str) -> np.ndarray:
    return np.array([ord(c) - _FIRST for c in chars])


def _with_names(pairs: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Counts of the pairs of words, and of names made of them; ``first`` and ``last`` count how words begin and end."""
    words = max(first.sum(), 1.0)
    low, high, digits, signs = (_at(x) for x in (string.ascii_lowercase, string.ascii_uppercase, string.digits, "_-/"))
    out = pairs.copy()
    out[np.ix_(high, high)] += CAPITALS * pairs[np.ix_(low, low)]
    out[np.ix_(high, low)] += CAPITALS * pairs[np.ix_(low, low)]
    begin, end = JOINED * first, JOINED * last
    begin[high] += CAPITALS * begin[low]
    end[high] += CAPITALS * end[low]
    capital = np.zeros(_SIZE)
    capital[high] = JOINED * first[low]
    out += np.outer(last, capital) / words
    out[:, signs] += end[:, None] / len(signs)
    out[signs, :] += begin / len(signs)
    out[:, digits] += end[:, None] / len(digits)
    out[digits, :] += begin / len(digits)
    number = JOINED * first.sum()
    out[np.ix_(digits, digits)] += number / len(digits) ** 2
    out[np.ix_(digits, signs)] += number / len(digits) / len(signs)
    out[np.ix_(signs, digits)] += number / len(digits) / len(signs)
    return out


def _shares(n: np.ndarray) -> np.ndarray:
    """For each character the shares of those after it, partly those of their kinds."""
    kinds = np.array([0 if c in string.ascii_lowercase else 1 if c in string.ascii_uppercase else 2 if c in string.digits else 3 for c in map(chr, range(_FIRST, _FIRST + _SIZE))])
    member = np.eye(4)[kinds]
    between = member.T @ n @ member + 0.5
    between /= between.sum(axis=1, keepdims=True)
    n = n + 0.5
    return (1 - BACKOFF) * n / n.sum(axis=1, keepdims=True) + BACKOFF * member @ between @ (member / member.sum(axis=0)).T


def train(docs: DataFrame, text: str = "text", random_rows: int = RANDOM_ROWS) -> Model:
    """Both models and the threshold, from one pass over ``docs``."""
    # Blanks are put around words before they are exploded: later, the optimiser would do it again for every pair.
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(IDENTIFIER), F.lit(0)), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    ordinary = docs.select(F.lit(0).alias("label"), F.explode(words).alias("s")).where(F.length("s") >= 6 + 2)
    counts = _pairs(ordinary.union(_random_strings(docs.sparkSession, random_rows))).collect()  # at most two numbers per pair
    n = np.zeros((2, _SIZE + 1, _SIZE + 1))  # the last row and column are the blanks around a word
    for label, pair, count in counts:
        a, b = (_SIZE if c == " " else ord(c) - _FIRST for c in pair)
        n[label, a, b] += count
    words_of = _with_names(n[0, :-1, :-1], n[0, -1, :-1], n[0, :-1, -1])
    ratios = np.log(_shares(n[1, :-1, :-1])) - np.log(_shares(words_of))
    share = words_of / max(words_of.sum(), 1.0)
    mean = float((share * ratios).sum())
    return Model([float(x) for x in ratios.ravel()], mean, float(np.sqrt((share * (ratios - mean) ** 2).sum())))


def ratio(token: Column, table: list[float]) -> Column:
    """Sum of the log ratios of the pairs of ``token`` (printable ASCII, two characters or more)."""
    numbers = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")  # folded into a literal
    pair = lambda c, i: F.get(numbers, (F.ascii(F.get(c, i)) - _FIRST) * _SIZE + F.ascii(F.get(c, i + 1)) - _FIRST)
    return let(F.split(token, ""), lambda c: F.aggregate(F.sequence(F.lit(0), F.length(token) - 2), F.lit(0.0), lambda s, i: s + pair(c, i)))


def _added(tokens: Column, base: Column, model: Model) -> Column:
    """``base`` and the random-looking tokens with letters and digits that overlap none of it."""
    def chosen(m: Column, shade: Column) -> Column:
        value = m["value"]
        pairs = F.length(value) - 1
        least = F.greatest(F.lit(LEAST_SUM), pairs * F.lit(model.mean) + F.sqrt(pairs) * F.lit(DEVIATIONS * model.deviation))
        score = ratio(value, model.ratios) >= least
        return F.when(~value.rlike("[0-9]") | ~value.rlike("[A-Za-z]") | spans.overlaps(m, shade), False).otherwise(score)

    more = let(spans.shadow(base), lambda shade: F.concat(base, spans.labelled(F.filter(tokens, lambda m: chosen(m, shade)), "random", len(KINDS))))
    return F.when(F.size(tokens) == 0, base).otherwise(more)


def with_spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (struct of the columns of ``docs``), ``base_spans``, ``spans``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    t = F.col("t")
    tokens = F.when(t.rlike("[A-Za-z0-9+/_=-]{16}"), matches(t, TOKEN)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    rows = rows.select("row", F.coalesce(F.col("row")[text], F.lit("")).alias("t"))
    rows = rows.select("row", base_spans(t).alias("base_spans"), tokens.alias("tokens"))
    return rows.select("row", "base_spans", _added(F.col("tokens"), F.col("base_spans"), model).alias("spans"))

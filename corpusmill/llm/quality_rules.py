"""Quality rules: a table of thresholds compiled into one projection.

Every metric is a Spark expression over the whole text, every rule a bound on a metric; ``judged`` puts all of
them into a single projection, without a shuffle and without user functions.

A rule may ask for a least number of words: a short text may do without any stop word.

Defined results: a NULL or empty text has no words, all counts are 0, and it is rejected. Ratios whose
denominator is 0 are 0. An empty table gives an empty result. Repeated rows are judged alike. Further columns of the input are kept by ``judged`` unless
their name is that of a metric; ``kept_rows`` returns the columns of its input only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.native import WORD, let, occurrences

# Symbols of the symbol count.
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "of", "on", "or", "that",
    "the", "this", "to", "was", "with", "you", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im",
    "ist", "mit", "nicht", "sich", "und", "von", "zu", "au", "avec", "dans", "de", "du", "en", "est", "et", "il",
    "la", "le", "les", "ne", "par", "pas", "pour", "que", "qui", "sur", "un", "une", "al", "con", "del", "el", "lo", "los",
    "las", "no", "para", "se", "su", "y",
)

# Punctuation that is cut off a word before it is looked up as a stop word.
PUNCTUATION = ".,;:!?\"'()[]{}<>*_-…«»„“”‚‘’¿¡"

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Keep a text when ``metric`` lies within [``least``, ``most``]; a text of fewer than ``from_words`` words is not judged by it."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


# The threshold table. Ratios are per word unless the name says otherwise.
RULES = (
    Rule("few_words", "n_words", least=10),
    Rule("repeated_words", "repeat_ratio", most=0.20),
    Rule("short_words", "mean_word_chars", least=2.0),
    Rule("long_words", "mean_word_chars", most=15.0),
    Rule("symbols", "symbol_ratio", most=0.20),
    Rule("exclamations", "exclamation_ratio", most=0.50),
    Rule("capitals", "capital_ratio", most=0.50),
    Rule("no_stop_words", "stop_ratio", least=0.01, from_words=100),
    Rule("repeated_lines", "dup_line_ratio", most=0.50),
)
BASE_RULES = ("few_words", "repeated_words")


def _repeat_words(words: Column) -> Column:
    """Words lying in a window of five that occurs at least twice in the text.

    Windows are compared by a 64-bit hash of their words. Most texts repeat none, which a distinct count shows;
    only the others are sorted to find which windows repeat and how many words these cover together.
    """
    def covered(hashes: Column) -> Column:
        at = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(F.sort_array(at), lambda s: let(F.sort_array(_repeating(s)), _union_length))

    def _repeating(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        marked = F.transform(s, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
        return F.filter(marked, lambda i: i.isNotNull())

    def _union_length(starts: Column) -> Column:
        step = lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - i, F.lit(WINDOW)))
        return F.aggregate(F.transform(starts, step), F.lit(0), lambda a, b: a + b)

    n = F.size(words)
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), window)
    return F.when(n <= WINDOW, 0).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    )


def _counts(text: Column) -> Column:
    """All counts of a text as one struct."""
    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
            occurrences(text, SYMBOLS).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).cast("bigint").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(PUNCTUATION))).isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
            occurrences(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("bigint").alias("n_capitals"),
            occurrences(text, "!").cast("bigint").alias("n_exclamations"),
            F.size(F.split(text, "\n", -1)).cast("bigint").alias("n_lines"),
        )

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)


def metrics(text: Column) -> Column:
    """Struct of counts and ratios of ``text``."""
    def with_ratios(c: Column) -> Column:
        per = lambda x, n: F.when(c[n] == 0, F.lit(0.0)).otherwise(c[x] / c[n])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(
            *[c[x].alias(x) for x in names],
            per("n_repeat_words", "n_words").alias("repeat_ratio"),
            per("word_chars", "n_words").alias("mean_word_chars"),
            per("n_symbols", "n_words").alias("symbol_ratio"),
            per("n_exclamations", "n_words").alias("exclamation_ratio"),
            per("n_capitals", "word_chars").alias("capital_ratio"),
            per("n_stop_words", "n_words").alias("stop_ratio"),
            per("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        )

    return let(_counts(F.coalesce(text, F.lit(""))), with_ratios)


def failed(rules: tuple[Rule, ...], metric: Column) -> Column:
    """Names of the rules that fail, as an array in table order."""
    def broken(rule: Rule) -> Column:
        x, out = metric[rule.metric], F.lit(False)
        if rule.least is not None:
            out = out | (x < rule.least)
        if rule.most is not None:
            # The share of repeated words is compared in whole numbers.
            out = out | (100 * metric["n_repeat_words"] > rule.most * 100 * metric["n_words"] if rule.metric == "repeat_ratio" else x > rule.most)
        if rule.from_words:
            out = out & (metric["n_words"] >= rule.from_words)
        return F.when(out, F.lit(rule.name))

    return F.filter(F.array(*[broken(r) for r in rules]), lambda x: x.isNotNull())


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``quality`` (struct of metrics), ``failed_rules`` and ``kept``."""
    measured = docs.withColumn("quality", metrics(F.col(text)))
    return measured.withColumn("failed_rules", failed(rules, F.col("quality"))).withColumn("kept", F.size("failed_rules") == 0)


def kept_rows(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows that break no rule, with the columns of ``docs``."""
    names = docs.columns
    # One expression: a filter on a computed column would compute it again for each rule.
    fine = let(metrics(F.col("row")[text]), lambda m: F.size(failed(rules, m)) == 0)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).where(fine).select("row.*")

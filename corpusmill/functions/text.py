"""Caption, log-line and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.randomness import let

# What counts as white space at the ends of a caption, the two log-line forms.
WHITE_SPACE = (
    r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
TRAINER_LINE = "step %07d | loss %.6f | %.1fs"
LOG_LINE = (
    r"step\s+(\d+)\s+\|\s+loss\s+([^\s|]+)\s+\|\s+"
    r"(?:shard\s+(\S+)|([0-9.]+)s(?:\s|$))"
)

MANIFEST_SCHEMA = "shard string, index bigint, path string, caption string"


def strip_all(text: Column) -> Column:
    """Remove white space of any kind from both ends (SQL ``trim`` removes spaces only)."""
    return F.regexp_replace(text, rf"^{WHITE_SPACE}+|{WHITE_SPACE}+\z", "")


def clean_caption(text: Column) -> Column:
    """A caption that fits one tab-separated line: stripped, tabs and line breaks as spaces."""
    return F.regexp_replace(strip_all(text), r"[\t\r\n]", " ")


def valid_text(content: Column) -> Column:
    """Bytes as text, undecodable bytes left out."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def trainer_line(step: Column, loss: Column, seconds: Column) -> Column:
    return F.format_string(TRAINER_LINE, step.cast("bigint"), loss.cast("double"), seconds.cast("double"))


def parsed_log_line(line: Column) -> Column:
    """Step, loss, shard and form of a log line; NULL when the line is something else.

    The loss is NULL when it is no number, so that such lines can be counted as rejects. The pattern
    runs once per line: its groups, which hold no white space, are written out one per line and split
    again. ``line`` must be a single line.
    """
    groups = F.split(F.regexp_replace(line, rf"\A.*?{LOG_LINE}.*\z", "$1\n$2\n$3"), "\n")

    def record(g: Column) -> Column:
        fields = F.struct(
            F.get(g, F.lit(0)).try_cast("bigint").alias("step"),
            F.get(g, F.lit(1)).try_cast("double").alias("loss"),
            F.nullif(F.get(g, F.lit(2)), F.lit("")).alias("shard"),
            F.when(F.get(g, F.lit(2)) != "", F.lit("shard")).otherwise(F.lit("seconds")).alias("form"),
        )
        return F.when(F.size(g) == 3, fields)

    return let(groups, record)


def manifest_line(shard: Column, index: Column, path: Column, caption: Column) -> Column:
    """One JSON record per sample; non-ASCII text is kept as it is."""
    return F.to_json(
        F.struct(
            shard.alias("shard"), index.alias("index"), path.alias("path"), caption.alias("caption")
        )
    )


def parsed_manifest_line(line: Column) -> Column:
    """The record of a manifest line; malformed lines give NULL fields."""
    return F.from_json(line, MANIFEST_SCHEMA)

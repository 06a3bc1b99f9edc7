"""Path, name and id expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The file types taken as images, the run-folder name and the numbered-shard name.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tiff")
RUN_NAME = "training_{date}_run_{number}"
RUN_DATE_FORMAT = "MM_dd_yyyy"
SHARD_NAME = "shard_%05d"
SHARD_NUMBER = r"shard_(\d{5,})\.pt$"

_EXTENSION = r"[^/](\.[^./]+)$"
_WITHOUT_EXTENSION = r"(?s)^(.*[^/])\.[^./]+$"


def extension(path: Column) -> Column:
    """Lower-cased last extension with its dot; '' for dot files and names without one."""
    return F.lower(F.regexp_extract(path, _EXTENSION, 1))


def has_extension(path: Column, extensions: Sequence[str] = IMAGE_EXTENSIONS) -> Column:
    return extension(path).isin([e.lower() for e in extensions])


def stem(path: Column) -> Column:
    """The path without its last extension: ``d/a.b.jpg`` gives ``d/a.b``."""
    return F.regexp_replace(path, _WITHOUT_EXTENSION, "$1")


def with_extension(path: Column, ext: str) -> Column:
    return F.concat(stem(path), F.lit(ext))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def first_folder(path: Column, root: str) -> Column:
    """First path segment below ``root``; '' when the path lies directly in ``root``."""
    return F.regexp_extract(rebased(path, root, ""), r"^/?([^/]+)/", 1)


def rebased(path: Column, old_root: str, new_root: str) -> Column:
    """Move a path from one root to another, keeping the relative part."""
    old = old_root.rstrip("/")
    return F.concat(F.lit(new_root.rstrip("/")), F.substring(path, len(old) + 1, 1 << 30))


def stored_path(path: Column, raw_dir: str, out_dir: str, store: bool = True) -> Column:
    """Where a kept file is listed: under ``out_dir/images`` when stored, else where it lies."""
    return rebased(path, raw_dir, f"{out_dir.rstrip('/')}/images") if store else path


def normalised(path: Column) -> Column:
    """``./a//b/./c`` as ``a/b/c``, so that two spellings of a path compare equal."""
    slashes = F.regexp_replace(path, r"(?<!:)/{2,}", "/")
    return F.regexp_replace(F.regexp_replace(slashes, r"(?:/\.)+(?=/|$)", ""), r"^(?:\./)+", "")


def zero_pad(number: Column, width: int = 5) -> Column:
    """Pad an integer with zeros; longer numbers are kept whole (``lpad`` would cut them)."""
    return F.format_string(f"%0{width}d", number.cast("bigint"))


def zero_fill(text: Column, width: int = 5) -> Column:
    """Pad a text with zeros; longer texts are kept whole."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def number_in(name: Column, pattern: str) -> Column:
    """The decimal number captured by group 1, NULL when the pattern does not match."""
    return F.regexp_extract(name, pattern, 1).try_cast("bigint")


def shard_name(number: Column) -> Column:
    return F.format_string(SHARD_NAME, number.cast("bigint"))


def shard_number(name: Column) -> Column:
    return number_in(name, SHARD_NUMBER)


def uri_parts(uri: Column, scheme: str = "s3", strict: bool = True) -> Column:
    """``scheme://bucket/key`` as a struct; another scheme raises, or gives NULL when not strict."""
    prefix = f"{scheme}://"
    parts = F.struct(
        F.regexp_extract(uri, rf"(?s)^{prefix}([^/]*)/?(.*)$", 1).alias("bucket"),
        F.regexp_extract(uri, rf"(?s)^{prefix}([^/]*)/?(.*)$", 2).alias("key"),
    )
    checked = F.when(uri.startswith(prefix), parts)
    if not strict:
        return checked
    message = F.concat(F.lit(f"expected {prefix}..., got: "), F.coalesce(uri, F.lit("NULL")))
    return checked.otherwise(F.raise_error(message).cast("struct<bucket:string,key:string>"))


def date_tag(at: Column) -> Column:
    return F.date_format(at, RUN_DATE_FORMAT)


def run_name(tag: Column, number: Column) -> Column:
    start, end = RUN_NAME.split("{date}")
    return F.concat(F.lit(start), tag, F.lit(end.replace("{number}", "")), F.format_string("%02d", number))


def run_number_pattern() -> str:
    """Group 1 is the date tag and group 2 the number of a run name."""
    return "^" + RUN_NAME.format(date=r"(\d{2}_\d{2}_\d{4})", number=r"(\d+)") + "$"


def image_glob(extensions: Sequence[str] = IMAGE_EXTENSIONS) -> str:
    """A file-name glob for the extensions in any letter case (Spark's glob filter minds the case)."""
    either = ("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions)
    return "*{" + ",".join(either) + "}"

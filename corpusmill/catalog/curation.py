"""Listing, parsing, validation, deduplication and pairing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query, r6, sql_r6
from corpusmill.functions import images, paths, rules
from corpusmill.functions import text as tx
from corpusmill.operators import curation, pairing, sampling
from corpusmill.plans.scan import scan_report
from corpusmill.sources import files as src
from corpusmill.sources import text as text_src

_STEM = r"(?s)^(.*[^/])\.[^./]+$"
_IS_IMAGE = rf"lower(regexp_extract(path, '[^/](\.[^./]+)$', 1)) IN {b.IMAGE_EXTENSIONS_SQL}"


def _checks():
    return rules.size_rules(F.col("width"), F.col("height"), b.MIN_SIDE, b.MIN_ASPECT, b.MAX_ASPECT)


def _judged(spark, sf_dir, keep=()):
    return curation.judge(b.files(spark, sf_dir), _checks(), "doc_id", F.col("content"), keep)


@query(
    "scan_ext",
    b.sql("files", f"""SELECT lower(regexp_extract(path, '[^/](\\.[^./]+)$', 1)) AS ext, count(*) AS n
    FROM files WHERE {_IS_IMAGE} GROUP BY 1"""),
)
def scan_ext(spark, sf_dir):
    return src.keep_extensions(b.files(spark, sf_dir), F.col("path")).groupBy("ext").agg(F.count("*").alias("n"))


@query(
    "pairs_parse",
    b.sql("files", """SELECT path, CASE WHEN doc_id % 3 = 0 THEN lang || chr(9) || source ELSE lang END AS caption FROM files"""),
)
def pairs_parse(spark, sf_dir):
    caption = F.when(F.col("doc_id") % 3 == 0, F.concat("lang", F.lit("\t"), "source")).otherwise(F.col("lang"))
    line = F.concat("path", F.lit("\t"), caption)
    with_blanks = F.when(F.col("doc_id") % 5 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))
    return text_src.parse_pairs(b.files(spark, sf_dir).select(F.explode(with_blanks).alias("value")))


@query("filelist_parse", b.sql("files", "SELECT path, '' AS caption FROM files"))
def filelist_parse(spark, sf_dir):
    line = F.concat(F.lit(" \t"), "path", F.lit("  　\r"))
    with_blanks = F.when(F.col("doc_id") % 5 == 0, F.array(line, F.lit(" \t "))).otherwise(F.array(line))
    return text_src.parse_filelist(b.files(spark, sf_dir).select(F.explode(with_blanks).alias("value")))


@query(
    "manifest_lenient",
    "SELECT 'e/' || event_id AS path, event_type AS caption FROM events WHERE event_id % 10 <> 0 AND event_id % 15 <> 1",
)
def manifest_lenient(spark, sf_dir):
    props = F.expr("substring(props, 2)")
    path = F.when(F.col("event_id") % 15 == 1, "").otherwise(F.concat(F.lit('"path": "e/'), "event_id", F.lit('", ')))
    line = F.concat(F.lit("{"), path, F.lit('"caption": "'), "event_type", F.lit('", '), props)
    cut = F.when(F.col("event_id") % 10 == 0, F.expr("substring(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    lines = b.table(spark, sf_dir, "events").withColumn("line", line).select(cut.alias("value"))
    return text_src.parse_manifest(lines).select("path", "caption")


@query(
    "stored_paths",
    b.sql("files", "SELECT path, 'out/images' || substr(path, 4) AS stored FROM files"),
)
def stored_paths(spark, sf_dir):
    return b.files(spark, sf_dir).select("path", paths.stored_path(F.col("path"), "raw", "out").alias("stored"))


@query(
    "funnel_reasons",
    b.sql("judged", "SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM judged GROUP BY 1"),
)
def funnel_reasons(spark, sf_dir):
    report = scan_report(b.files(spark, sf_dir), _checks(), "doc_id", F.col("content"), include_ok=True)
    return report.reasons


@query(
    "scan_report",
    b.sql("files verdicts", f"""SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM
    (SELECT CASE WHEN rejected IS NOT NULL THEN rejected
        WHEN row_number() OVER (PARTITION BY rejected, sha ORDER BY path) > 1 THEN 'duplicate_sha1' END AS reason
    FROM verdicts WHERE {_IS_IMAGE}) GROUP BY 1"""),
)
def scan_report_query(spark, sf_dir):
    """The flagship: extension filter, first failing rule, exact dedupe by path order, counts."""
    candidates = src.keep_extensions(b.files(spark, sf_dir), F.col("path"))
    return scan_report(candidates, _checks(), "path", F.col("content"), include_ok=True).reasons


@query(
    "funnel_summary",
    b.sql("judged", """SELECT count(*) AS candidates, count(*) FILTER (reason IS NULL) AS valid,
    count(*) FILTER (reason IS NOT NULL) AS rejected FROM judged"""),
)
def funnel_summary(spark, sf_dir):
    return scan_report(b.files(spark, sf_dir), _checks(), "doc_id", F.col("content")).summary


@query(
    "reject_rows",
    b.sql("judged", "SELECT doc_id, source, reason FROM judged WHERE reason IS NOT NULL"),
)
def reject_rows(spark, sf_dir):
    return _judged(spark, sf_dir, ["source"]).filter(F.col("reason").isNotNull())


@query(
    "aspect_filter",
    b.sql("files", f"""SELECT doc_id, h AS height, {sql_r6('ratio')} AS ratio, ratio BETWEEN {b.MIN_ASPECT} AND {b.MAX_ASPECT} AS pass
    FROM (SELECT doc_id, h, CASE WHEN h = 0 THEN 0 ELSE width::DOUBLE / h END AS ratio FROM
    (SELECT doc_id, width, unnest([height, 0]) AS h FROM files))"""),
)
def aspect_filter(spark, sf_dir):
    width, height = F.col("width"), F.col("height")
    rows = b.files(spark, sf_dir).select(
        "doc_id", "width", F.explode(F.array(height.cast("bigint"), F.lit(0).cast("bigint"))).alias("height")
    )
    return rows.select(
        "doc_id",
        "height",
        r6(rules.aspect_ratio(width, height)).alias("ratio"),
        rules.within_aspect(width, height, b.MIN_ASPECT, b.MAX_ASPECT).alias("pass"),
    )


@query("valid_rows", b.sql("judged", "SELECT doc_id FROM judged WHERE reason IS NULL"))
def valid_rows(spark, sf_dir):
    return scan_report(b.files(spark, sf_dir), _checks(), "doc_id", F.col("content")).valid


@query(
    "dedupe_sha1",
    b.sql("files", "SELECT sha1(content) AS sha1, min(doc_id) AS kept, count(*) AS copies FROM files GROUP BY 1"),
)
def dedupe_sha1(spark, sf_dir):
    hashed = b.files(spark, sf_dir).select("doc_id", F.sha1("content").alias("sha1"))
    return curation.keepers(hashed, "sha1", "doc_id")


_WS = tx.WHITE_SPACE


@query(
    "clean_caption",
    f"""SELECT conv_id, turn, regexp_replace(regexp_replace(chr(9) || ' ' || text || chr(9) || role || chr(10) || chr(12288),
    '^{_WS}+|{_WS}+\\z', '', 'g'), '[\\t\\r\\n]', ' ', 'g') AS caption FROM conversations""",
)
def clean_caption(spark, sf_dir):
    raw = F.concat(F.lit("\t "), "text", F.lit("\t"), "role", F.lit("\n　"))
    return b.table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.clean_caption(raw).alias("caption"))


_PAIRS_SQL = f"""SELECT f.path, replace(s.caption, chr(9), ' ') AS caption, f.source AS source
    FROM files f JOIN sidecars s ON regexp_replace(f.path, '{_STEM}', '\\1') = regexp_replace(s.path, '{_STEM}', '\\1')
    WHERE {_IS_IMAGE.replace('path', 'f.path')}"""


def _pairs(spark, sf_dir):
    pictures = src.keep_extensions(b.files(spark, sf_dir).select("path", "source"), F.col("path"))
    return pairing.pair_by_stem(pictures, b.sidecars(spark, sf_dir), F.col("caption"), keep=("source",))


@query("pair_sidecar", b.sql("files sidecars", f"SELECT path, caption FROM ({_PAIRS_SQL})"))
def pair_sidecar(spark, sf_dir):
    return _pairs(spark, sf_dir).select("path", "caption")


@query(
    "pairs_per_archive",
    b.sql("files sidecars", f"SELECT source, count(*) AS n FROM ({_PAIRS_SQL}) GROUP BY source"),
)
def pairs_per_archive(spark, sf_dir):
    return pairing.pair_count(_pairs(spark, sf_dir), "source")


@query(
    "skip_existing",
    b.sql("files", "SELECT 'out/images' || substr(path, 4) AS path FROM files WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
)
def skip_existing(spark, sf_dir):
    stored = paths.stored_path(F.col("path"), "raw", "out").alias("path")
    docs = b.files(spark, sf_dir).select("doc_id", "path")
    there = docs.join(b.table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select(stored)
    return curation.skip_existing(docs.select(stored), there)


@query(
    "dataset_bytes",
    b.sql("files", "SELECT source, count(*) AS n, CAST(sum(width) AS BIGINT) AS bytes FROM files GROUP BY source"),
)
def dataset_bytes(spark, sf_dir):
    return curation.dataset_bytes(b.files(spark, sf_dir), "source", "width")


@query(
    "audit_sample",
    b.sql("judged", f"""SELECT doc_id FROM judged WHERE reason IS NULL
    ORDER BY {b.sql_digest(sampling.AUDIT_SEED, 'doc_id')}, doc_id LIMIT {sampling.AUDIT_SIZE}"""),
)
def audit_sample(spark, sf_dir):
    return sampling.sample_n(valid_rows(spark, sf_dir), sampling.AUDIT_SIZE, ["doc_id"])


@query(
    "crop_box",
    b.sql("files", """SELECT doc_id, least(width, height) AS side, (width - least(width, height)) // 2 AS "left",
    (height - least(width, height)) // 2 AS top FROM files"""),
)
def crop_box(spark, sf_dir):
    box = images.crop_square(F.col("width"), F.col("height"))
    return b.files(spark, sf_dir).select("doc_id", box.alias("box")).select("doc_id", "box.*")


@query(
    "zero_pad",
    "SELECT doc_id * 9973 AS value, printf('%05d', doc_id * 9973) AS padded, printf('%05d', doc_id * 9973) AS filled FROM documents",
)
def zero_pad(spark, sf_dir):
    value = F.col("doc_id") * 9973
    return b.table(spark, sf_dir, "documents").select(
        value.alias("value"), paths.zero_pad(value).alias("padded"), paths.zero_fill(value.cast("string")).alias("filled")
    )


@query(
    "uri_parts",
    """SELECT page_id, split_part(rest, '/', 1) AS bucket,
    CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/') + 1) ELSE '' END AS key
    FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS rest FROM pages)""",
)
def uri_parts(spark, sf_dir):
    uri = F.regexp_replace("url", "^[a-z]+://", "s3://")
    parts = b.table(spark, sf_dir, "pages").select("page_id", paths.uri_parts(uri).alias("p"))
    return parts.select("page_id", "p.bucket", "p.key")


def _hex(value, digits: int, little: bool = False):
    """An integer column as hex digits, most or least significant byte first."""
    text = F.lpad(F.hex(value.cast("bigint")), digits, "0")
    return F.concat(*[F.substring(text, i, 2) for i in range(digits - 1, 0, -2)]) if little else text


def _image_bytes(kind, width, height):
    """The smallest file of each type that has a size: a head and no pixels; and one that is cut off."""
    w, h = (lambda digits, little=False: _hex(width, digits, little)), (lambda digits, little=False: _hex(height, digits, little))
    ihdr = F.concat(F.lit("49484452"), w(8), h(8), F.lit("0802000000"))
    files = [
        F.concat(F.lit("89504E470D0A1A0A0000000D"), ihdr, _hex(F.crc32(F.unhex(ihdr)), 8), F.lit("0000000049454E44AE426082")),
        F.concat(F.lit("FFD8FFE000041234FFC0000B08"), h(4), w(4), F.lit("01011100")),
        F.concat(F.lit("424D"), F.lit("00" * 12), F.lit("28000000"), w(8, True), h(8, True)),
        F.concat(F.lit("49492A0008000000020000010400"), F.lit("01000000"), w(8, True), F.lit("010104000100" + "0000"), h(8, True), F.lit("00000000")),
        F.concat(F.lit("4D4D002A000000080002" + "0100000300000001"), w(4), F.lit("0000" + "0101000300000001"), h(4), F.lit("0000" + "00000000")),
        F.concat(F.lit("5249464616000000" + "57454250" + "565038580A00000000000000"), _hex(width - 1, 6, True), _hex(height - 1, 6, True)),
        F.concat(F.lit("89504E470D0A1A0A0000000D"), ihdr),
    ]
    return F.unhex(F.element_at(F.array(*files), (kind + 1).cast("int")))


@query(
    "image_headers",
    """SELECT doc_id, doc_id % 7 <> 6 AS ok, CASE WHEN doc_id % 7 <> 6 THEN (doc_id % 900 + 1)::INTEGER END AS width,
    CASE WHEN doc_id % 7 <> 6 THEN (doc_id * 7 % 600 + 1)::INTEGER END AS height,
    doc_id % 7 <> 6 AND least(doc_id % 900 + 1, doc_id * 7 % 600 + 1) >= 256
      AND (doc_id % 900 + 1)::DOUBLE / (doc_id * 7 % 600 + 1) BETWEEN 0.5 AND 2 AS hashed FROM documents""",
)
def image_headers(spark, sf_dir):
    """A file head of each type per document, judged by its bytes; those within the limits are hashed, and the hash is that of the bytes."""
    width, height = F.col("doc_id") % 900 + 1, F.col("doc_id") * 7 % 600 + 1
    docs = b.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), _image_bytes(F.col("doc_id") % 7, width, height).alias("content"))
    found = src.examine_images(docs, hashing=True).join(docs.select("path", F.sha1("content").alias("own")), "path")
    return found.select(
        F.col("path").cast("bigint").alias("doc_id"), "verdict.ok", "verdict.width", "verdict.height", F.coalesce(F.col("sha1") == F.col("own"), F.lit(False)).alias("hashed")
    )

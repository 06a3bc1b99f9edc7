"""Files written from the given tables and read back: lists, pairs, loss tables, images, encodes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query, r6, sql_r6
from corpusmill.functions import text as tx
from corpusmill.operators import models
from corpusmill.plans.scan import scan_corpus
from corpusmill.session import scratch_folder
from corpusmill.sources import files as src
from corpusmill.sources import text as text_src

_PATHS = "SELECT doc_id, 'raw/' || coalesce(lang, 'none') || '/' || printf('%09d', doc_id) || '.png' AS path FROM documents"


def _paths(spark, sf_dir):
    path = F.concat(F.lit("raw/"), F.coalesce("lang", F.lit("none")), F.lit("/"), F.format_string("%09d", "doc_id"), F.lit(".png"))
    return b.table(spark, sf_dir, "documents").select("doc_id", path.alias("path"))


@query("filelist_file", f"SELECT path, '' AS caption FROM ({_PATHS})")
def filelist_file(spark, sf_dir):
    """The list of files, written and then chosen as the input because there is no file of pairs."""
    folder = scratch_folder(spark, "list")
    text_src.write_filelist(_paths(spark, sf_dir), f"{folder}/filelist")
    return text_src.choose_input(spark, f"{folder}/pairs", f"{folder}/filelist").select("path", "caption")


@query("pairs_file", f"SELECT path, 'c ' || (doc_id % 7) || ' é x' AS caption FROM ({_PATHS})")
def pairs_file(spark, sf_dir):
    """Pairs whose captions hold a tab and a line break, written, chosen as the input and read."""
    folder = scratch_folder(spark, "pairs")
    caption = F.concat(F.lit(" c\t"), F.col("doc_id") % 7, F.lit(" é\nx "))
    text_src.write_pairs(_paths(spark, sf_dir).withColumn("caption", caption), f"{folder}/pairs")
    return text_src.choose_input(spark, f"{folder}/pairs", f"{folder}/filelist").select("path", "caption")


@query("loss_file", f"SELECT event_id AS step, {sql_r6('value::DOUBLE')} AS loss FROM events")
def loss_file(spark, sf_dir):
    """A loss table written in two goes."""
    path = scratch_folder(spark, "loss")
    rows = b.table(spark, sf_dir, "events").select(F.col("event_id").alias("step"), F.col("value").cast("double").alias("loss"))
    for part in ("step % 3 = 0", "step % 3 <> 0"):
        text_src.append_loss(rows.filter(part), path)
    return text_src.read_loss_csv(spark, path).select("step", r6(F.col("loss")).alias("loss"))


@query("text_of_bytes", "SELECT doc_id, sha1(coalesce(text, '') || 'b') AS sha1 FROM documents")
def text_of_bytes(spark, sf_dir):
    """Bytes that are no text, inside and at the end, left out."""
    raw = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.lit("FF62C3")))
    return b.table(spark, sf_dir, "documents").select("doc_id", F.sha1(tx.valid_text(raw).cast("binary")).alias("sha1"))


# --- images ---------------------------------------------------------------------------------------

_W, _H, _V = "(doc_id % 13 + 4)", "(doc_id * 7 % 11 + 4)", "(doc_id % 5)"


def _little(value, digits):
    text = F.lpad(F.hex(value.cast("bigint")), digits, "0")
    return F.concat(*[F.substring(text, i, 2) for i in range(digits - 1, 0, -2)])


def _bitmap(width, height, value):
    """An uncompressed image of one colour."""
    stride = F.floor((width * 3 + 3) / 4) * 4
    head = F.concat(
        F.lit("424D"), _little(54 + stride * height, 8), F.lit("0000000036000000" + "28000000"), _little(width, 8), _little(height, 8),
        F.lit("01001800" + "00000000"), _little(stride * height, 8), F.lit("00" * 16),
    )
    return F.unhex(F.concat(head, F.repeat(F.lpad(F.hex(value.cast("bigint")), 2, "0"), (stride * height).cast("int"))))


_JUDGED = f"""SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'corrupt_or_unreadable' WHEN least({_W}, {_H}) < 6 THEN 'too_small'
    WHEN NOT {_W}::DOUBLE / {_H} BETWEEN 0.5 AND 2 THEN 'bad_aspect_ratio' END AS reason,
    row_number() OVER (PARTITION BY doc_id % 17 = 0, {_W}, {_H}, {_V} ORDER BY doc_id) AS copy FROM documents"""


@query(
    "scan_folder",
    f"""SELECT reason, count(*) AS n FROM (SELECT coalesce(reason, CASE WHEN copy > 1 THEN 'duplicate_sha1' ELSE 'kept' END) AS reason
    FROM ({_JUDGED})) GROUP BY reason""",
)
def scan_folder(spark, sf_dir):
    """One image file per document, some of them broken, small, narrow or copies, written to a folder and scanned."""
    folder = scratch_folder(spark, "scan")
    width, height, value = (F.expr(x) for x in (_W, _H, _V))
    content = F.when(F.col("doc_id") % 17 == 0, F.lit("BM, but no image").cast("binary")).otherwise(_bitmap(width, height, value))
    path = F.concat(F.lit(f"{folder}/raw/set [1]/"), F.format_string("%09d é.bmp", "doc_id"))
    src.write_files(b.table(spark, sf_dir, "documents").select(path.alias("path"), content.alias("content")))
    scan = scan_corpus(spark, f"{folder}/raw", f"{folder}/out", min_side=6, dedupe=True, audit=20)
    kept = text_src.read_filelist(spark, f"{folder}/out/filelist")
    return scan.report.reasons.unionByName(kept.agg(F.count("*").alias("n")).select(F.lit("kept").alias("reason"), "n"))


@query(
    "image_files",
    f"SELECT doc_id, doc_id % 17 <> 0 AS ok, CASE WHEN doc_id % 17 <> 0 THEN {_W}::INTEGER END AS width, CASE WHEN doc_id % 17 <> 0 THEN {_V}::INTEGER END AS first FROM documents",
)
def image_files(spark, sf_dir):
    """The same kind of files, decoded in full; ``first`` is the first byte of the pixels."""
    folder = scratch_folder(spark, "images")
    content = F.when(F.col("doc_id") % 17 == 0, F.lit("BM, but no image").cast("binary")).otherwise(_bitmap(F.expr(_W), F.expr(_H), F.expr(_V)))
    path = F.concat(F.lit(f"{folder}/a b+%20/"), F.format_string("%09d.bmp", "doc_id"))
    src.write_files(b.table(spark, sf_dir, "documents").select(path.alias("path"), content.alias("content")))
    first = F.conv(F.hex(F.substring("data", 1, 1)), 16, 10).cast("int")
    return src.read_in_rounds(
        spark, src.read_images, folder, lambda found: found.select(
            F.regexp_extract("path", r"a b\+%20/(\d+)\.bmp$", 1).cast("bigint").alias("doc_id"), "verdict.ok", "verdict.width",
            F.when(F.col("verdict.ok"), first).alias("first"),
        ),
    )


def _square(content: bytes) -> np.ndarray:
    """A square picture from its raw bytes."""
    side = int(np.sqrt(len(content) / 3))
    if side == 0:
        raise RuntimeError("no pixels")
    return np.frombuffer(content, dtype=np.uint8)[: side * side * 3].reshape(side, side, 3)


@query(
    "encode_images",
    """SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'encode_failed:RuntimeError' END AS reason,
    CASE WHEN doc_id % 10 <> 0 THEN doc_id % 256 END AS colour FROM documents""",
)
def encode_images(spark, sf_dir):
    """Pictures of one colour, resized and encoded in batches; a tenth does not decode. The colour is computed back from the latent."""
    pixel = F.lpad(F.hex(F.col("doc_id") % 256), 2, "0")
    content = F.when(F.col("doc_id") % 10 == 0, F.lit("").cast("binary")).otherwise(F.unhex(F.repeat(pixel, 3 * 20 * 20)))
    rows = b.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.lit("").alias("caption"), content.alias("content"))
    encoded = models.encode_batches(rows, models.block_average(), 16, 4, decoder=_square)
    colour = F.round((F.get("latent", F.lit(5)).cast("double") / F.col("latent_scale") + 1) / 2 * 255).cast("bigint")
    return encoded.select(F.col("path").cast("bigint").alias("doc_id"), "reason", colour.alias("colour"))

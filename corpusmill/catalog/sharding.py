"""Shards, manifests, resume and incremental ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog import bindings as b
from corpusmill.catalog.registry import query
from corpusmill.functions import paths
from corpusmill.operators import ordered, resume, sampling
from corpusmill.plans.shards import manifest_check
from corpusmill.session import scratch_folder
from corpusmill.sources import files as src
from corpusmill.sources import shards as store
from corpusmill.sources import text as text_src

_SIZE, _START = 50, 3


@query(
    "shard_read",
    b.sql("shards", """SELECT sample, dataset, shard, index,
    CASE WHEN sample % 4 = 0 THEN 0.18215::DOUBLE ELSE 0.5::DOUBLE END AS latent_scale FROM shards"""),
)
def shard_read(spark, sf_dir):
    stored = F.when(F.col("sample") % 4 != 0, F.lit(0.5))
    return b.shard_keys(spark, sf_dir).withColumn("latent_scale", store.default_scale(stored))


@query(
    "dataset_folders",
    b.sql("latents", "SELECT dataset, count(*) AS files FROM latents GROUP BY dataset"),
)
def dataset_folders(spark, sf_dir):
    path = F.concat(F.lit("store/"), "dataset", F.lit("/"), "sample", F.lit(".pt"))
    return src.list_datasets(b.latents(spark, sf_dir).select(path.alias("path")), "store")


def _shard_path():
    return F.concat(F.lit("store/"), "dataset", F.lit("/"), paths.shard_name(F.col("shard")), F.lit(".pt"))


@query(
    "shard_inventory",
    b.sql("shards", """SELECT DISTINCT 'store/' || dataset || '/' || printf('shard_%05d', shard) || '.pt' AS path,
    printf('shard_%05d', shard) || '.pt' AS name FROM shards"""),
)
def shard_inventory(spark, sf_dir):
    listing = b.shard_keys(spark, sf_dir).select(_shard_path().alias("path"))
    return src.distinct_sorted(listing, "path").withColumn("name", paths.basename(F.col("path")))


@query(
    "shard_shuffle",
    b.sql("shards", f"""SELECT row_number() OVER (ORDER BY {b.sql_digest(b.SHUFFLE_SEED, 'path')}, path) - 1 AS position, path FROM
    (SELECT DISTINCT 'store/' || dataset || '/' || printf('shard_%05d', shard) || '.pt' AS path FROM shards)"""),
)
def shard_shuffle(spark, sf_dir):
    listing = b.shard_keys(spark, sf_dir).select(_shard_path().alias("path"))
    return src.list_shards(listing, seed=b.SHUFFLE_SEED, strict=False).select("position", "path")


_ASSIGNED = f"""SELECT doc_id, path, lang, {_START} + (rn - 1) // {_SIZE} AS shard, (rn - 1) % {_SIZE} AS index FROM
    (SELECT doc_id, path, lang, row_number() OVER (ORDER BY doc_id) AS rn FROM files)"""


def _assigned(spark, sf_dir):
    keys = b.files(spark, sf_dir).select("doc_id", "path", "lang")
    return store.with_shards(keys, ["doc_id"], _SIZE, _START)


@query("shard_assign", b.sql("files", f"SELECT doc_id, shard, index FROM ({_ASSIGNED})"))
def shard_assign(spark, sf_dir):
    return _assigned(spark, sf_dir).select("doc_id", "shard", "index")


@query(
    "manifest_build",
    b.sql("files", f"""SELECT to_json({{'shard': printf('shard_%05d', shard), 'index': index, 'path': path,
    'caption': lang || ' é"' || chr(9)}})::VARCHAR AS value FROM ({_ASSIGNED})"""),
)
def manifest_build(spark, sf_dir):
    rows = _assigned(spark, sf_dir).withColumn("caption", F.concat("lang", F.lit(' é"\t')))
    return store.manifest_lines(store.manifest_of(rows))


@query(
    "batches_drop_last",
    """SELECT (rn - 1) // 128 AS batch, count(*) AS rows FROM
    (SELECT row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS total FROM documents)
    WHERE rn <= total // 128 * 128 GROUP BY 1""",
)
def batches_drop_last(spark, sf_dir):
    numbered = ordered.with_ordinal(b.table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])
    whole = sampling.complete_batches(numbered, 128)
    return whole.groupBy(sampling.batch_of(F.col("ordinal"), 128).alias("batch")).agg(F.count("*").alias("rows"))


@query(
    "resume_anti",
    b.sql("listed", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM listed)"),
)
def resume_anti(spark, sf_dir):
    manifest = text_src.parse_manifest(b.manifest_lines(spark, sf_dir))
    rows = b.table(spark, sf_dir, "documents").select("doc_id", b.file_path().alias("path"))
    return resume.resume_remaining(rows, manifest).select("doc_id")


@query(
    "max_items_resume",
    """SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)
    WHERE rn <= (SELECT count(*) FROM documents) * 3 // 10 AND doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def max_items_resume(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", b.file_path().alias("path"))
    done = docs.join(b.table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select("path")
    first = resume.max_items(docs, docs.count() * 3 // 10, ["doc_id"])
    return resume.resume_remaining(first, done).select("doc_id")


@query(
    "skip_processed",
    b.sql("done", "SELECT DISTINCT doc_id % 41 AS id FROM documents WHERE doc_id % 41 NOT IN (SELECT id FROM done)"),
)
def skip_processed(spark, sf_dir):
    ids = b.table(spark, sf_dir, "documents").select((F.col("doc_id") % 41).alias("id")).distinct()
    return resume.skip_processed(ids, b.done_archives(spark, sf_dir))


@query(
    "next_shard",
    b.sql("shards", "SELECT dataset, CASE WHEN dataset = 'set_9' THEN 0 ELSE max(shard) + 1 END AS next FROM shards GROUP BY dataset"),
)
def next_shard(spark, sf_dir):
    name = F.when(F.col("dataset") == "set_9", F.lit("readme.txt")).otherwise(F.concat(paths.shard_name(F.col("shard")), F.lit(".pt")))
    return resume.next_shard(b.shard_keys(spark, sf_dir), name, ["dataset"])


@query(
    "next_archives",
    b.sql("done", """, last AS (SELECT max(id) AS id FROM done),
    free AS (SELECT r AS id FROM range((SELECT id + 11 FROM last)) t(r) WHERE r NOT IN (SELECT id FROM done))
    SELECT 'max' AS mode, id, printf('%05d', id) AS archive FROM free WHERE id > (SELECT id FROM last)
    UNION ALL SELECT 'gaps', id, printf('%05d', id) FROM (SELECT id FROM free ORDER BY id LIMIT 10)"""),
)
def next_archives(spark, sf_dir):
    done = b.done_archives(spark, sf_dir)
    latest = resume.next_archives(done, 10).withColumn("mode", F.lit("max"))
    return latest.unionByName(resume.next_archives(done, 10, "gaps").withColumn("mode", F.lit("gaps")))


@query(
    "next_run",
    """SELECT strftime(ts, '%m_%d_%Y') AS tag, 'training_' || strftime(ts, '%m_%d_%Y') || '_run_' ||
    printf('%02d', max(hour(ts)) + 2) AS name FROM
    (SELECT date_trunc('day', ts) AS day, ts FROM events) GROUP BY strftime(ts, '%m_%d_%Y')""",
)
def next_run(spark, sf_dir):
    names = b.table(spark, sf_dir, "events").select(
        paths.run_name(paths.date_tag(F.col("ts")), F.hour("ts") + 1).alias("name")
    )
    return resume.next_runs(names)


@query(
    "manifest_integrity",
    b.sql("shards", """SELECT count(*) FILTER (sample % 9 = 0) AS missing, count(*) FILTER (sample % 50 = 1) AS extra,
    count(*) FILTER (sample % 50 = 1 AND sample % 9 <> 0) AS duplicate_paths, CAST(0 AS BIGINT) AS broken_shards FROM shards"""),
)
def manifest_integrity(spark, sf_dir):
    shards = b.shard_keys(spark, sf_dir)
    rows = shards.withColumn("path", F.concat(F.lit("p/"), "sample"))
    listed = rows.filter(F.col("sample") % 9 != 0)
    extra = rows.filter(F.col("sample") % 50 == 1).withColumn("index", F.col("index") + 1000)
    return manifest_check(listed.unionByName(extra), shards, ["dataset", "shard", "index"])


_COPIES = """SELECT coalesce(source, 'none') AS dataset, printf('raw/%08d.png', doc_id // 2) AS path, doc_id::VARCHAR AS caption, doc_id,
    CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END AS run FROM documents"""
_STORED = f"""
WITH d AS ({_COPIES}),
n AS (SELECT *, row_number() OVER (PARTITION BY dataset, run ORDER BY path, caption) - 1 AS pos FROM d),
f AS (SELECT dataset, (max(pos) FILTER (WHERE run = 1) // {_SIZE} + 1) AS first FROM n GROUP BY dataset)
SELECT dataset, (CASE WHEN run = 2 THEN coalesce(first, 0) ELSE 0 END + pos // {_SIZE})::INTEGER AS shard, (pos % {_SIZE})::BIGINT AS index, path, caption,
  (doc_id % 512)::DOUBLE AS value FROM n JOIN f USING (dataset)
"""


def _stored_twice(spark, sf_dir, precision):
    """Encoded samples whose paths all repeat, in two committed runs with a stopped one between; returns the root."""
    root = scratch_folder(spark, "store")
    docs = b.table(spark, sf_dir, "documents").select(
        F.coalesce("source", F.lit("none")).alias("dataset"), F.format_string("raw/%08d.png", F.floor(F.col("doc_id") / 2).cast("bigint")).alias("path"),
        F.col("doc_id").cast("string").alias("caption"), F.array((F.col("doc_id") % 512).cast("float"), F.lit(0.5)).alias("latent"),
        F.array(F.lit(2)).alias("shape"), F.lit(16).alias("image_size"), F.lit("none").alias("encoder_id"), F.lit(1.0).alias("latent_scale"), "doc_id",
    )
    for part, commit in (("doc_id % 5 <> 0", True), ("doc_id % 5 = 0", False), ("doc_id % 5 = 0", True)):
        store.write_shards(docs.filter(part).drop("doc_id"), root, ["path", "caption"], _SIZE, precision, commit)
    store.append_manifest(store.unlisted_samples(spark, root), root)
    return root


@query("shard_store", _STORED)
def shard_store(spark, sf_dir):
    found = store.read_shards(spark, _stored_twice(spark, sf_dir, "fp16"))
    return found.select("dataset", "shard", "index", "path", "caption", F.get("latent", F.lit(0)).cast("double").alias("value"))


@query(
    "shard_store_check",
    f"""WITH d AS ({_COPIES}) SELECT 0::BIGINT AS missing, 0::BIGINT AS extra,
    (SELECT count(*) FROM (SELECT path FROM d GROUP BY path HAVING count(*) > 1))::BIGINT AS duplicate_paths, 0::BIGINT AS broken_shards,
    (SELECT count(*) FROM d)::BIGINT AS found""",
)
def shard_store_check(spark, sf_dir):
    """The manifest against the shards, and how many records find their payload."""
    root = _stored_twice(spark, sf_dir, "fp32")
    manifest, shards = store.stored_manifest(spark, root), store.read_shards(spark, root)
    named = shards.withColumn("shard", paths.shard_name(F.col("shard")))
    checked = manifest_check(manifest, named, ["dataset", "shard", "index"])
    return checked.withColumn("found", F.lit(store.positional_lookup(manifest, shards).count()).cast("bigint"))

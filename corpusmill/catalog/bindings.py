"""How the given tables stand in for files, sidecars, latents, logs and checkpoints.

Each view is defined twice: as a DataFrame, and as the SQL of the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.randomness import digest
from corpusmill.operators import ordered
from corpusmill.sources.shards import with_shards

EXTENSIONS = (".jpg", ".JPEG", ".png", ".webp", ".bmp", ".tiff", ".txt")
IMAGE_EXTENSIONS_SQL = "('.jpg', '.jpeg', '.png', '.webp', '.bmp', '.tiff')"
SHARD_ROWS = 20
TIMESTEPS = 1000
BATCH = 8
SHUFFLE_SEED = 7
T_SEED = 11
EPS_SEED = 12
MIN_SIDE, MIN_ASPECT, MAX_ASPECT = 50, 4.0, 6.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- DataFrames -----------------------------------------------------------------------------------


def file_path(doc_id: str = "doc_id", source: str = "source"):
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col(doc_id) % 7 + 1).cast("int"))
    return F.concat(F.lit("raw/"), F.col(source), F.lit("/"), F.format_string("%09d", F.col(doc_id)), ext)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, path, width, height, content``."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        file_path().alias("path"),
        F.col("n_chars").alias("width"),
        F.regexp_count("text", F.lit(r"\S+")).alias("height"),
        F.col("text").alias("content"),
    )


def sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, path, caption``; the caption has a tab."""
    names = table(spark, sf_dir, "documents").select("doc_id", "source")
    return (
        table(spark, sf_dir, "labels")
        .join(names, "doc_id")
        .select(
            "doc_id",
            F.concat(F.lit("raw/"), "source", F.lit("/"), F.format_string("%09d", "doc_id"), F.lit(".txt")).alias("path"),
            F.concat(F.lit("q"), "quality", F.lit("\tt"), "toxic").alias("caption"),
        )
    )


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: JSON lines of the labelled documents; every tenth is cut short, and every other path
    is spelt with a leading ``./``."""
    names = table(spark, sf_dir, "documents").select("doc_id", file_path().alias("path"))
    numbered = ordered.with_ordinal(table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"], name="at")
    spelt = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("./"), "path")).otherwise(F.col("path"))
    line = F.concat(
        F.lit('{"shard": "shard_00000", "index": '), "at", F.lit(', "path": "'), spelt, F.lit('", "caption": ""}')
    )
    cut = F.when((F.col("at") + 1) % 10 == 0, F.substring(line, 1, 40)).otherwise(line)
    return numbered.join(names, "doc_id").select(cut.alias("value"))


def latents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample, x, y, dataset``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sample"),
        F.col("embedding").cast("array<double>").alias("x"),
        F.col("label").alias("y"),
        F.concat(F.lit("set_"), F.col("label")).alias("dataset"),
    )


def shard_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample, dataset, shard, index``."""
    keys = latents(spark, sf_dir).select("sample", "dataset")
    return with_shards(keys, ["sample"], SHARD_ROWS, by=["dataset"])


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample, dataset, shard, index, x, y``."""
    return with_payload(spark, sf_dir, shard_keys(spark, sf_dir))


def with_payload(spark: SparkSession, sf_dir: str, keys: DataFrame) -> DataFrame:
    return keys.join(latents(spark, sf_dir).select("sample", "x", "y"), "sample")


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One training step per sample of the set."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("step"))


def with_t(df: DataFrame) -> DataFrame:
    """A timestep per sample."""
    from corpusmill.functions.randomness import uniform_int

    return df.withColumn("t", uniform_int(TIMESTEPS, T_SEED, F.lit("t"), F.col("sample")))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines_of(table(spark, sf_dir, "events"))


def log_lines_of(events: DataFrame) -> DataFrame:
    """``value``: a line per event in one of the two forms; every seventeenth is noise."""
    loss = F.format_string("%.2f", "value")
    with_shard = F.concat_ws("", F.lit("step "), "event_id", F.lit(" | loss "), loss, F.lit(" | shard "), "event_type")
    timed = F.concat(
        F.lit("step "), F.format_string("%07d", "event_id"), F.lit(" | loss "), loss, F.lit(" | "),
        F.format_string("%.1f", (F.col("event_id") % 50) / 10.0), F.lit("s"),
    )
    line = (
        F.when(F.col("event_id") % 17 == 0, F.concat(F.lit("saving checkpoint at step "), "event_id"))
        .when(F.col("event_id") % 2 == 0, with_shard)
        .otherwise(timed)
    )
    return events.select(line.alias("value"))


def checkpoint_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _params(spark, sf_dir).filter(F.col("vec_id") % 10 != 0).drop("vec_id")


def checkpoint_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    shrunk = F.transform("values", lambda v: v * 0.9)
    shorter = F.col("vec_id") % 50 == 1
    return (
        _params(spark, sf_dir)
        .filter(F.col("vec_id") % 7 != 0)
        .withColumn("values", F.when(shorter, F.slice(shrunk, 1, 32)).otherwise(shrunk))
        .withColumn("shape", F.array(F.size("values")))
        .drop("vec_id")
    )


def _params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.format_string("layer.%04d", "vec_id").alias("param"),
        F.array(F.size("embedding")).alias("shape"),
        F.col("embedding").cast("array<double>").alias("values"),
    )


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, ts, bytes``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("name"), "ts", F.round(F.col("value") * 100).cast("bigint").alias("bytes")
    )


def done_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id``: source numbers not divisible by 4."""
    number = F.substring("source", 4, 20).cast("bigint")
    return table(spark, sf_dir, "documents").select(number.alias("id")).distinct().filter(F.col("id") % 4 != 0)


# --- SQL ------------------------------------------------------------------------------------------


def sql_digest(seed: int, *key: str) -> str:
    return "md5(concat_ws(':', " + ", ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in key]]) + "))"


def sql_unit(hexed: str, start: int = 1) -> str:
    return f"(CAST('0x' || substr({hexed}, {start}, 13) AS BIGINT) / 4503599627370496::DOUBLE)"


def sql_uniform(seed: int, *key: str) -> str:
    return sql_unit(sql_digest(seed, *key))


def sql_uniform_int(n: str, seed: int, *key: str) -> str:
    return f"CAST(floor({sql_uniform(seed, *key)} * {n}) AS BIGINT)"


def sql_gaussian(i: str, seed: int, *key: str) -> str:
    """The i-th (0-based) value of a noise array."""
    hexed = sql_digest(seed, *key, f"({i} // 2)")
    radius = f"sqrt(-2::DOUBLE * ln(1::DOUBLE - {sql_unit(hexed, 1)}))"
    angle = f"(2::DOUBLE * pi() * {sql_unit(hexed, 14)})"
    return f"({radius} * CASE WHEN {i} % 2 = 0 THEN cos({angle}) ELSE sin({angle}) END)"


_SQL_PATH = (
    "'raw/' || source || '/' || printf('%09d', doc_id) || "
    "(['.jpg', '.JPEG', '.png', '.webp', '.bmp', '.tiff', '.txt'])[doc_id % 7 + 1]"
)

VIEWS = {
    "files": f"""SELECT doc_id, source, lang, {_SQL_PATH} AS path, n_chars AS width,
        len(regexp_extract_all(text, '\\S+')) AS height, text AS content FROM documents""",
    "sidecars": """SELECT doc_id, 'raw/' || source || '/' || printf('%09d', doc_id) || '.txt' AS path,
        'q' || quality || chr(9) || 't' || toxic AS caption FROM labels JOIN documents USING (doc_id)""",
    "listed": f"""SELECT doc_id, {_SQL_PATH} AS path FROM
        (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM labels) JOIN documents USING (doc_id)
        WHERE rn % 10 <> 0""",
    "latents": """SELECT vec_id AS sample, CAST(embedding AS DOUBLE[]) AS x, label AS y,
        'set_' || label AS dataset FROM embeddings""",
    "elements": "SELECT sample, y, dataset, unnest(x) AS v, unnest(range(len(x))) AS pos FROM latents",
    "shards": f"""SELECT sample, dataset, x, y, (rn - 1) // {SHARD_ROWS} AS shard, (rn - 1) % {SHARD_ROWS} AS index
        FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY sample) AS rn FROM latents)""",
    "sizes": f"""SELECT *, row_number() OVER (ORDER BY {sql_digest(SHUFFLE_SEED, 'path')}, path) - 1 AS position FROM
        (SELECT dataset, shard, dataset || '/' || printf('shard_%05d', shard) AS path, count(*) AS rows
        FROM shards GROUP BY dataset, shard)""",
    "draws": f"""SELECT step, slot, dataset, shard,
        {sql_uniform_int('rows', SHUFFLE_SEED, "'index'", 'step', 'slot')} AS index,
        {sql_uniform_int(str(TIMESTEPS), SHUFFLE_SEED, "'t'", 'step', 'slot')} AS t
        FROM (SELECT vec_id AS step, unnest(range({BATCH})) AS slot FROM embeddings) s
        JOIN sizes ON position = step % (SELECT count(*) FROM sizes)""",
    "schedule": f"""SELECT t, beta, 1::DOUBLE - beta AS alpha,
        product(1::DOUBLE - beta) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING) AS alpha_bar FROM
        (SELECT t, 0.0001::DOUBLE + t * ((0.02::DOUBLE - 0.0001::DOUBLE) / {TIMESTEPS - 1}) AS beta
        FROM range({TIMESTEPS}) r(t))""",
    "timed": f"SELECT *, {sql_uniform_int(str(TIMESTEPS), T_SEED, chr(39) + 't' + chr(39), 'sample')} AS t FROM latents",
    "noised": f"""SELECT sample, y, dataset, t, beta, alpha, alpha_bar, pos, v, {sql_gaussian('pos', EPS_SEED, 'sample')} AS eps
        FROM (SELECT *, unnest(x) AS v, unnest(range(len(x))) AS pos FROM timed) JOIN schedule USING (t)""",
    "log_lines": """SELECT event_id, event_type, value AS loss, CASE
        WHEN event_id % 17 = 0 THEN 'saving checkpoint at step ' || event_id
        WHEN event_id % 2 = 0 THEN 'step ' || event_id || ' | loss ' || printf('%.2f', value) || ' | shard ' || event_type
        ELSE 'step ' || printf('%07d', event_id) || ' | loss ' || printf('%.2f', value) || ' | '
            || printf('%.1f', (event_id % 50) / 10.0::DOUBLE) || 's' END AS line FROM events""",
    "log": """SELECT event_id AS step, CAST(printf('%.2f', loss) AS DOUBLE) AS loss,
        CASE WHEN event_id % 2 = 0 THEN event_type END AS shard,
        CASE WHEN event_id % 2 = 0 THEN 'shard' ELSE 'seconds' END AS form
        FROM log_lines WHERE event_id % 17 <> 0""",
    "ckpt_a": """SELECT printf('layer.%04d', vec_id) AS param, CAST(embedding AS DOUBLE[]) AS vals
        FROM embeddings WHERE vec_id % 10 <> 0""",
    "ckpt_b": """SELECT printf('layer.%04d', vec_id) AS param, CASE WHEN vec_id % 50 = 1 THEN vals[1:32] ELSE vals END AS vals
        FROM (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda v: v * 0.9::DOUBLE) AS vals
        FROM embeddings WHERE vec_id % 7 <> 0)""",
    "norms": """SELECT param, sqrt(sum(d * d)) AS l2, max(abs(d)) AS linf, count(*) AS n FROM
        (SELECT param, unnest(list_transform(list_zip(a.vals, b.vals), lambda p: p[1] - p[2])) AS d
        FROM ckpt_a a JOIN ckpt_b b USING (param) WHERE len(a.vals) = len(b.vals)) GROUP BY param""",
    "done": """SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS id FROM documents
        WHERE CAST(substr(source, 4) AS BIGINT) % 4 <> 0""",
    "verdicts": f"""SELECT *, CASE WHEN least(width, height) < {MIN_SIDE} THEN 'too_small'
        WHEN NOT (CASE WHEN height = 0 THEN 0 ELSE width::DOUBLE / height END) BETWEEN {MIN_ASPECT} AND {MAX_ASPECT}
        THEN 'bad_aspect_ratio' END AS rejected, sha1(content) AS sha FROM files""",
    "judged": """SELECT *, CASE WHEN rejected IS NOT NULL THEN rejected
        WHEN row_number() OVER (PARTITION BY rejected, sha ORDER BY doc_id) > 1 THEN 'duplicate_sha1' END AS reason
        FROM verdicts""",
}

_NEEDS = {
    "elements": ["latents"],
    "shards": ["latents"],
    "sizes": ["shards"],
    "draws": ["sizes"],
    "timed": ["latents"],
    "noised": ["timed", "schedule"],
    "log": ["log_lines"],
    "norms": ["ckpt_a", "ckpt_b"],
    "verdicts": ["files"],
    "judged": ["verdicts"],
}


def sql(views: str, select: str, recursive: str = "") -> str:
    """A statement over the named views and the views those are made from."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in chosen:
            chosen.append(name)

    for name in views.split():
        add(name)
    parts = [f"{name} AS ({VIEWS[name]})" for name in chosen]
    if recursive:
        return "WITH RECURSIVE " + ", ".join([*parts, recursive]) + " " + select
    return ("WITH " + ", ".join(parts) + " " if parts else "") + select


# The moving average of each event type, as a recursion.
FOLDED = """
    numbered AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events),
    folded AS (SELECT event_id, event_type, rn, value AS ema FROM numbered WHERE rn = 1
        UNION ALL SELECT n.event_id, n.event_type, n.rn, 0.98::DOUBLE * f.ema + (1 - 0.98::DOUBLE) * n.value
        FROM folded f JOIN numbered n ON n.event_type = f.event_type AND n.rn = f.rn + 1)"""

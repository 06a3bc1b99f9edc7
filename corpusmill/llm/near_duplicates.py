"""Near-duplicate groups by SuperMinHash.

1. One pass over the texts gives each document the size, a 64-bit fingerprint and a bitmap of its shingle set, and the
   band keys of its SuperMinHash signature. No set leaves its task.
2. Documents of equal fingerprint are one *class*; from here on there is one row per class, so a group of exact
   copies of any size is one row.
3. Classes that share a band key are candidates. Buckets are not expanded into all pairs. In rounds, each bucket
   that still holds more than one component checks its members against some leaders, on full sets; what links is
   merged by union-find, the leaders have then met everyone and leave the bucket, and buckets that hold one component are
   finished, since links inside a component change nothing. Small remainders are checked pair by pair.
   The bits in which two bitmaps differ bound the similarity of the sets from above: pairs that cannot reach the threshold are
   dropped inside the join, and their texts are never fetched.
   Nothing is capped: a bucket is finished only when each pair of its members was checked or lies in one component.

Two of n different sets share a fingerprint with a probability of about ``n**2 / 2**65``.
A link of similarity s is missed with probability ``(1 - s**rows)**bands``: 3.9e-7 at 0.8 with the default 28 bands of 4.

Defined results: NULL and empty texts and texts without words have size 0 and are linked with nothing. The
component of a row is the smallest id in it, NULL only if all its ids are NULL. Rows that share an id but not a text
are different documents; equal rows are equal. Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import bytetext
from corpusmill.llm.components import components
from corpusmill.session import scratch_folder, shared_folder

BANDS = 28
ROWS = 4
LEADERS = 2
GROWTH = 16  # of the number of leaders from round to round
SMALL_BUCKET = 16
_WORDS = 16  # 64-bit words of a bitmap; a power of two
_CHUNK = 200_000  # elements whose permutations are held at a time
_NO_ID = -(1 << 63)


def superminhash(elements: np.ndarray, rows: np.ndarray, n_rows: int, slots: int) -> np.ndarray:
    """Signatures (``n_rows`` x ``slots``) of sets given as 64-bit hashes and the row of each.

    At level j each element takes the j-th place of its own permutation of the slots and offers ``j + r`` there, r
    uniform; a slot keeps its minimum. Once all slots of a row hold a value, later levels only offer more, so the row
    stops: a row of n elements takes about ``slots * log(slots) / n`` levels.
    """
    out = np.full((n_rows, slots), np.inf)
    flat = out.reshape(-1)
    places = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elements), 1))
    active = np.arange(len(elements))
    for j in range(slots):
        x = bytetext.mix(elements[active] + bytetext.U64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        r = (x >> bytetext.U64(33)).astype(np.float64) * 2.0**-31
        k = j + (((x & bytetext.U64(0xFFFFFFFF)) * bytetext.U64(slots - j)) >> bytetext.U64(32)).astype(np.int64)
        slot = places[active, k]
        places[active, k] = places[active, j]
        row = rows[active]
        np.minimum.at(flat, row * slots + slot, j + r)
        here = np.flatnonzero(np.bincount(row, minlength=n_rows))
        open_row = np.zeros(n_rows, dtype=bool)
        open_row[here] = np.isinf(out[here]).any(axis=1)
        active = active[open_row[row]]
        if not active.size:
            break
    return out


def _band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for i in range(rows):
        key = bytetext.mix(key * bytetext.U64(0xD6E8FEB86659FD93) + bits[:, :, i])
    return key.view(np.int64)


def _bitmaps(elements: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """``n_rows`` x ``_WORDS``: for each row the bits that the leading bits of its elements name."""
    bit = (elements >> bytetext.U64(64 - (64 * _WORDS - 1).bit_length())).astype(np.int64)
    out = np.zeros(n_rows * _WORDS, dtype=np.uint64)
    np.bitwise_or.at(out, rows * _WORDS + (bit >> 6), bytetext.U64(1) << (bit & 63).astype(np.uint64))
    return out.view(np.int64).reshape(n_rows, _WORDS)


def _fingerprint(shingles: np.ndarray) -> int | None:
    """64 bits of a digest of the whole set; None for the empty set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


def _sketches(batches: Iterator[pa.RecordBatch], shingle_words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in bytetext.blocks(batch.column(2)):
            sets = bytetext.shingle_sets(block, shingle_words)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            prints = [_fingerprint(s) for s in sets]
            keys = np.zeros((block.rows, bands), dtype=np.int64)
            bits = np.zeros((block.rows, _WORDS), dtype=np.int64)
            at = 0
            while at < block.rows:
                stop = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), _CHUNK, side="right")) + at)
                part = np.concatenate(sets[at:stop])
                if len(part):
                    owner = np.repeat(np.arange(stop - at), sizes[at:stop])
                    keys[at:stop] = _band_keys(superminhash(part, owner, stop - at, bands * rows), bands, rows)
                    bits[at:stop] = _bitmaps(part, owner, stop - at)
                at = stop
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(block.rows + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1))) for x in (keys, bits)
            ]
            span = slice(block.first, block.first + block.rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[span], batch.column(1)[span], pa.array(sizes), pa.array(prints, type=pa.int64()), *lists],
                names=["id", "tie", "size", "class", "bands", "bits"],
            )


def _checked(batches: Iterator[pa.RecordBatch], shingle_words: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Labels of the pairs ``a, la, lb, ta, tb`` whose full sets are at least as similar as ``threshold``; rows come in order of ``a``."""
    percent = round(threshold * 100)
    last: tuple[int, np.ndarray] | None = None
    for batch in batches:
        names = batch.column(0).to_pylist()
        for block in bytetext.blocks(batch.column(4)):
            sets = bytetext.shingle_sets(block, shingle_words)
            linked = []
            for i, b in enumerate(sets):
                at = block.first + i
                if last is None or last[0] != names[at]:
                    alone = next(bytetext.blocks(pa.array([batch.column(3)[at].as_py()], type=pa.large_string())))
                    last = (names[at], bytetext.shingle_sets(alone, shingle_words)[0])
                a = last[1]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    linked.append(at)
            keep = pa.array(linked, type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1).take(keep), batch.column(2).take(keep)], names=["a", "b"])


def _reachable(a_bits: Column, a_size: Column, b_bits: Column, b_size: Column, percent: int) -> Column:
    """Whether the bitmaps leave room for an intersection that reaches ``percent`` of the union.

    Each bit in which they differ stands for another shingle of only one set, so ``differ`` bounds the symmetric difference from below.
    """
    differ = sum(F.bit_count(F.get(a_bits, F.lit(i)).bitwiseXOR(F.get(b_bits, F.lit(i)))) for i in range(_WORDS))
    return (100 + percent) * differ <= (100 - percent) * (a_size + b_size)


def _row_id(column: Column) -> Column:
    return F.coalesce(column.cast("bigint"), F.lit(_NO_ID))


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``id, tie, n_shingles, component_id, first``, one row for each row of ``docs``.

    ``tie`` tells apart rows that share an id. ``first`` marks the row of a component to stay: of all its classes the one
    that holds the smallest ``(id, tie)``; it is true for each of several equal rows.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    texts = docs.select(_row_id(F.col(key)).alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    sketch_path, class_path, text_path = (scratch_folder(spark, f"near-{x}") for x in ("sketches", "classes", "texts"))
    texts.mapInArrow(
        lambda batches: _sketches(batches, shingle_words, bands, rows),
        "id bigint, tie bigint, size bigint, class bigint, bands array<bigint>, bits array<bigint>",
    ).write.parquet(sketch_path)
    sketches = spark.read.parquet(sketch_path)

    # Equal classes have equal bands and bits, so any of them serves.
    sketches.where("class is not null").groupBy("class").agg(
        F.min(F.struct("id", "tie")).alias("rep"), F.max("size").alias("size"), F.any_value("bands").alias("bands"), F.any_value("bits").alias("bits")
    ).write.parquet(class_path)
    classes = spark.read.parquet(class_path)

    # One row per class with the band keys it shares; a class has at most ``bands`` of them.
    members = classes.select("class", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    common = members.join(shared, "band").groupBy("class").agg(F.collect_list("band").alias("bands"))
    candidates = common.join(classes.select("class", "rep", "size", "bits"), "class").checkpoint()

    # Whole texts of the classes that have any candidate.
    wanted = candidates.select("class", "rep.id", "rep.tie")
    texts.join(wanted, ["id", "tie"]).select("class", "text").dropDuplicates(["class"]).write.parquet(text_path)
    bodies = spark.read.parquet(text_path)

    grouped = classes.select("class", "rep", F.col("class").alias("group"))
    for merged in _linked(candidates.drop("rep"), bodies, shingle_words, threshold):
        grouped = _relabelled(grouped, "group", merged)
    ids = sketches.where("class is not null").groupBy("class").agg(F.min(F.when(F.col("id") != _NO_ID, F.col("id"))).alias("least"))
    grouped = grouped.join(ids, "class").checkpoint()
    best = grouped.groupBy("group").agg(F.min("least").alias("component_id"), F.min(F.struct(F.col("least").isNull(), "least", "rep")).alias("best"))
    named = grouped.join(best, "group").select(
        "class", "component_id", (F.col("best")["rep"] == F.col("rep")).alias("stays"), F.col("best")["least"].alias("best_id")
    )
    out = sketches.select("id", "tie", F.col("size").alias("n_shingles"), "class").join(named, "class", "left")
    # A document without words is its own component.
    own = F.when(F.col("id") != _NO_ID, F.col("id"))
    alone = F.col("class").isNull()
    first = alone | (F.col("stays") & F.coalesce(F.col("id") == F.col("best_id"), F.lit(True)))
    return out.select(own.alias("id"), "tie", "n_shingles", F.when(alone, own).otherwise(F.col("component_id")).alias("component_id"), first.alias("first"), "class")


def _linked(candidates: DataFrame, bodies: DataFrame, shingle_words: int, threshold: float) -> list[DataFrame]:
    """Maps ``node, component`` to apply one after the other to a class to get its component; nodes not in a map stay.

    ``candidates``: ``class, bands, size, bits``, one row per class. Labels are kept per class; only members of buckets are one row per band.
    """
    percent = round(threshold * 100)
    maps: list[DataFrame] = []
    open_classes = candidates.withColumn("label", F.col("class"))
    while True:
        members = open_classes.select("class", "size", "bits", "label", F.explode("bands").alias("band"))
        state = members.groupBy("band").agg(
            F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
        ).where("low != high").select("band", "n")
        left = members.join(state, "band").checkpoint()
        if left.isEmpty():
            return maps
        # In a small bucket everyone leads. A large one gets a few leaders by one aggregate, of those outside its largest
        # component: once these have met everyone, one component is left. Later rounds take more leaders, so rounds are few.
        large = left.where(F.col("n") > SMALL_BUCKET)
        most = large.groupBy("band", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("band").agg(F.max_by("label", "c").alias("main"))
        slot = F.pmod(F.xxhash64("class"), F.lit(LEADERS * GROWTH ** len(maps)))
        led = large.join(most, "band").where("label != main").groupBy("band", slot.alias("slot")).agg(
            F.min("class").alias("a"), F.min_by("label", "class").alias("label"), F.min_by("size", "class").alias("size"), F.min_by("bits", "class").alias("bits")
        )
        leaders = left.where(F.col("n") <= SMALL_BUCKET).select("band", F.col("class").alias("a"), F.col("label").alias("la"), F.col("size").alias("sa"), F.col("bits").alias("ba"))
        leaders = leaders.union(led.select("band", "a", "label", "size", "bits")).checkpoint()
        near = (100 * F.least("sa", "size") >= percent * F.greatest("sa", "size")) & (F.col("la") != F.col("label"))
        near = near & _reachable(F.col("ba"), F.col("sa"), F.col("bits"), F.col("size"), percent)
        either = F.when(F.col("n") <= SMALL_BUCKET, F.col("a") < F.col("class")).otherwise(F.col("a") != F.col("class"))
        pairs = left.join(leaders, "band").where(near & either)
        low = F.col("a") < F.col("class")
        pairs = pairs.select(
            F.least("a", "class").alias("a"), F.greatest("a", "class").alias("b"),
            F.when(low, F.col("la")).otherwise(F.col("label")).alias("la"), F.when(low, F.col("label")).otherwise(F.col("la")).alias("lb"),
        ).distinct()
        sides = pairs.join(bodies.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a").join(bodies.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b")
        links = (
            sides.select("a", "la", "lb", "ta", "tb").sortWithinPartitions("a")
            .mapInArrow(lambda batches: _checked(batches, shingle_words, threshold), "a bigint, b bigint")
        )
        merged = components(links)
        maps.append(merged)
        # What a class still has to meet: its large buckets but those it led.
        marks = large.select("class", "band", F.lit(False).alias("led")).union(led.select(F.col("a").alias("class"), "band", F.lit(True).alias("led")))
        rest = marks.groupBy("class").agg(
            F.array_except(F.collect_list(F.when(~F.col("led"), F.col("band"))), F.collect_list(F.when(F.col("led"), F.col("band")))).alias("bands")
        ).where(F.size("bands") > 0)
        open_classes = _relabelled(rest.join(open_classes.drop("bands"), "class"), "label", merged).checkpoint()


def _relabelled(rows: DataFrame, name: str, merged: DataFrame) -> DataFrame:
    joined = rows.join(merged, F.col(name) == F.col("node"), "left")
    return joined.withColumn(name, F.coalesce("component", name)).drop("node", "component")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, columns unchanged.

    Rows without words all stay; of equal rows with words one stays.
    """
    found = near_duplicates(docs, key, text, **options).where("first").select(
        F.coalesce("id", F.lit(_NO_ID)).alias("id"), "tie", F.coalesce("class", F.xxhash64("id", "tie")).alias("class"),
        F.col("class").isNull().alias("wordless"),
    )
    winners = found.dropDuplicates(["class"]).select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), "wordless")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_id(F.col(key)).alias("id"), F.xxhash64(text).alias("tie"))
    kept = rows.join(winners, (F.col("id") == F.col("_id")) & (F.col("tie") == F.col("_tie")))
    turn = F.row_number().over(Window.partitionBy("id", "tie").orderBy("wordless"))
    return kept.withColumn("turn", turn).where((F.col("turn") == 1) | F.col("wordless")).select("row.*")

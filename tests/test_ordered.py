"""Segmented scans against the plain loop, on several partition counts and with a hot group."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators import ordered

PARTITIONS = [1, 3, 8]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(600):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randrange(40)}"
        out.append((i, group, rng.uniform(0, 10)))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, grp string, x double").repartition(5)


def by_group(rows):
    groups = defaultdict(list)
    for i, g, x in sorted(rows):
        groups[g].append((i, x))
    return groups


def loop_ema(values, alpha):
    out, v = [], None
    for x in values:
        v = x if v is None else alpha * v + (1 - alpha) * x
        out.append(v)
    return out


@pytest.mark.parametrize("parts", PARTITIONS)
def test_ordinal(frame, rows, parts):
    got = {r.id: r.ordinal for r in ordered.with_ordinal(frame, ["id"], partitions=parts).collect()}
    assert got == {i: i for i in range(600)}


@pytest.mark.parametrize("parts", PARTITIONS)
def test_ordinal_by_group(frame, rows, parts):
    got = {
        r.id: r.ordinal
        for r in ordered.with_ordinal(frame, ["id"], by=["grp"], partitions=parts).collect()
    }
    want = {i: n for items in by_group(rows).values() for n, (i, _) in enumerate(items)}
    assert got == want


@pytest.mark.parametrize("parts", PARTITIONS)
@pytest.mark.parametrize("by", [[], ["grp"]])
def test_running_sum(frame, rows, parts, by):
    got = {r.id: r.running for r in ordered.running_sum(frame, "x", ["id"], by, partitions=parts).collect()}
    groups = by_group(rows) if by else {"": [(i, x) for i, _, x in sorted(rows)]}
    for items in groups.values():
        total = 0.0
        for i, x in items:
            total += x
            assert got[i] == pytest.approx(total, abs=1e-9)


@pytest.mark.parametrize("parts", PARTITIONS)
@pytest.mark.parametrize("by", [[], ["grp"]])
def test_previous_value(frame, rows, parts, by):
    got = {r.id: r.previous for r in ordered.previous_value(frame, "x", ["id"], by, partitions=parts).collect()}
    groups = by_group(rows) if by else {"": [(i, x) for i, _, x in sorted(rows)]}
    for items in groups.values():
        before = None
        for i, x in items:
            assert got[i] == before
            before = x


@pytest.mark.parametrize("parts", PARTITIONS)
@pytest.mark.parametrize("by", [[], ["grp"]])
@pytest.mark.parametrize("alpha", [0.0, 0.5, 0.98, 1.0])
def test_ema(spark, frame, rows, parts, by, alpha):
    previous = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {r.id: r.ema for r in ordered.ema(frame, "x", ["id"], by, alpha, partitions=parts).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", previous)
    groups = by_group(rows) if by else {"": [(i, x) for i, _, x in sorted(rows)]}
    for items in groups.values():
        for (i, _), want in zip(items, loop_ema([x for _, x in items], alpha)):
            assert got[i] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("parts", PARTITIONS)
def test_ema_nan_stays(spark, parts):
    xs = [float(i) for i in range(50)]
    xs[20] = math.nan
    df = spark.createDataFrame(list(enumerate(xs)), "id bigint, x double")
    got = {r.id: r.ema for r in ordered.ema(df, "x", ["id"], alpha=0.9, partitions=parts).collect()}
    want = loop_ema(xs, 0.9)
    for i in range(50):
        assert math.isnan(got[i]) if i >= 20 else got[i] == pytest.approx(want[i])


def test_ema_with_null_groups(spark):
    rows = [(i, None if i % 3 == 0 else "a" if i % 3 == 1 else "", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, grp string, x double")
    got = {r.id: r.ema for r in ordered.ema(df, "x", ["id"], ["grp"], 0.5, partitions=4).collect()}
    for key in (None, "a", ""):
        items = [(i, x) for i, g, x in rows if g == key]
        for (i, _), want in zip(items, loop_ema([x for _, x in items], 0.5)):
            assert got[i] == pytest.approx(want)


def test_empty_input(spark):
    df = spark.createDataFrame([], "id bigint, grp string, x double")
    assert ordered.with_ordinal(df, ["id"]).count() == 0
    assert ordered.ema(df, "x", ["id"], ["grp"]).count() == 0
    assert ordered.running_sum(df, "x", ["id"], ["grp"]).count() == 0


def test_wide_rows_keep_their_payload(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "id bigint, body string")
    got = {r.id: (r.body, r.ordinal) for r in ordered.number_rows(df, "id", ["id"], partitions=3).collect()}
    assert got == {i: (f"text {i}", i) for i in range(40)}


# --- keys and values of every kind ----------------------------------------------------------------

KEYS = {
    "timestamp": "timestamp_micros(1700000000000000 + cast(id % 7 as bigint))",
    "ntz": "cast(timestamp_micros(1700000000000000 + cast(id % 5 as bigint) * 3) as timestamp_ntz)",
    "double": "case id % 4 when 0 then double('NaN') when 1 then null when 2 then 0.5D else -1D end",
    "binary": "case when id % 3 = 0 then null else cast(concat('k', id % 3) as binary) end",
    "decimal": "cast(id % 3 as decimal(30, 12)) / 7",
    "string": "case when id % 3 = 0 then null else concat('é', id % 3) end",
    "struct": "named_struct('a', id % 3, 'b', timestamp_micros(cast(id % 2 as bigint)))",
    "date": "date_add(date'2024-01-01', cast(id % 3 as int))",
}
VALUES = {
    "long": "case when id % 6 = 0 then null else id * 1000000007 end",
    "decimal": "cast(id as decimal(20, 3)) / 8",
    "double": "case when id % 9 = 0 then null else id / 7D end",
    "int": "cast(id as int)",
}


@pytest.fixture(scope="module")
def kinds(spark):
    keys = [f"{text} as k_{name}" for name, text in KEYS.items()]
    values = [f"{text} as v_{name}" for name, text in VALUES.items()]
    return spark.range(200).selectExpr("id", *keys, *values).repartition(6).checkpoint()


@pytest.mark.parametrize("key", [f"k_{k}" for k in KEYS])
@pytest.mark.parametrize("parts", [1, 8])
def test_scans_equal_windows_for_keys_of_every_kind(kinds, key, parts):
    window = Window.partitionBy(key).orderBy("id")
    rows = kinds.select("id", key, "v_long", "v_double")
    want = rows.select("id", (F.row_number().over(window) - 1).alias("n"), F.sum("v_long").over(window).alias("s"), F.lag(key).over(window).alias("p"))
    ordinal = ordered.with_ordinal(rows, ["id"], [key], "n", parts)
    summed = ordered.running_sum(rows, "v_long", ["id"], [key], "s", parts)
    lagged = ordered.previous_value(rows, key, ["id"], [key], "p", parts)
    got = ordinal.select("id", "n").join(summed.select("id", "s"), "id").join(lagged.select("id", "p"), "id")
    text = [F.col("id"), F.col("n").cast("bigint"), "s", F.col("p").cast("string")]
    assert sorted(map(tuple, got.select(*text).collect()), key=repr) == sorted(map(tuple, want.select(*text).collect()), key=repr)


@pytest.mark.parametrize("value", [f"v_{v}" for v in VALUES])
@pytest.mark.parametrize("by", [(), ("k_timestamp",)])
def test_sums_of_every_kind(kinds, value, by):
    window = Window.partitionBy(*by).orderBy("id")
    want = kinds.select("id", F.sum(value).over(window).alias("s"))
    got = ordered.running_sum(kinds, value, ["id"], by, "s", 5).select("id", "s")
    assert got.schema["s"].dataType == want.schema["s"].dataType
    for a, b in zip(got.orderBy("id").collect(), want.orderBy("id").collect()):
        assert a.id == b.id and (a.s == b.s or a.s == pytest.approx(b.s))


def test_average_of_timestamp_groups(kinds):
    got = {r.id: r.e for r in ordered.ema(kinds, "v_int", ["id"], ["k_timestamp"], 0.5, "e", 8).collect()}
    for first in range(7):
        ids = range(first, 200, 7)
        assert [got[i] for i in ids] == pytest.approx(loop_ema(list(ids), 0.5))


def test_sum_beyond_its_type_is_an_error(spark):
    rows = spark.range(4).selectExpr("id", "9223372036854775807L as v")
    with pytest.raises(Exception, match="(?i)overflow|too large|bounds|int"):
        ordered.running_sum(rows, "v", ["id"], partitions=1).collect()


def test_one_exchange_of_data(spark, kinds):
    """The plan that makes the stored segments shuffles once; the plan above them moves one row per segment."""
    rows = ordered._range_sorted(kinds.select("id"), ["id"], 4).mapInArrow(lambda b: b, "id bigint")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan
    whole = ordered.with_ordinal(kinds.select("id", "k_string"), ["id"], ["k_string"], partitions=4)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(k_string" not in plan and "SortMergeJoin" not in plan

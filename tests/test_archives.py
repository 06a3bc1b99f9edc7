"""Archives in byte ranges against reading them from the start."""

from __future__ import annotations

import io
import os
import tarfile

import fixtures as fx
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.plans import ingest
from corpusmill.sources import archives, text
from corpusmill.sources.archives import _walk_range, stitched


def packed(members, kind=tarfile.GNU_FORMAT):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=kind) as tar:
        for name, content in members:
            info = tarfile.TarInfo(name)
            if content is None:
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
            else:
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
    return out.getvalue()


def samples(seed, n=60):
    """Members of 0 to 5,000 bytes, folders, long and non-ASCII names."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        name = f"d{i % 3}/{i:05d}é.bin" if i % 4 else "long/" * 40 + f"{i:05d}.bin"
        out.append((f"dir{i}", None) if i % 11 == 5 else (name, rng.bytes(int(rng.integers(0, 5000)))))
    return out


def plain(data):
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:") as tar:
        return sorted((m.name, m.offset_data, m.size) for m in tar if m.isfile())


def by_ranges(data, size):
    """Members that the stitched claims of all ranges give, or None if a claim does not fit; no Spark."""
    rows, heads = [], []
    for begin in range(0, len(data), size):
        given = {"archive": "a", "length": len(data), "begin": begin, "end": min(begin + size, len(data))}
        for batch in _walk_range(io.BytesIO(data), given):
            rows += batch.to_pylist()
    frame = pd.DataFrame(rows)
    plan = stitched(frame[frame["mark"]])
    members = frame[~frame["mark"].astype(bool)]
    for p in plan.itertuples():
        own = members[(members["begin"] == p.begin) & (members["chain"] == p.chain)]
        if not p.sure and p.need not in set(own["header"]):
            return None
        heads += own[(own["header"] >= p.need) & own["regular"].astype(bool)][["member", "offset", "size"]].itertuples(index=False, name=None)
    return sorted((m, int(o), int(s)) for m, o, s in heads)


RANGES = [512, 1024, 4096, 20_480, 1 << 20]


@pytest.mark.parametrize("size", RANGES)
@pytest.mark.parametrize("kind", [tarfile.GNU_FORMAT, tarfile.PAX_FORMAT, tarfile.USTAR_FORMAT])
def test_ranges_give_the_members_of_the_whole(size, kind):
    members = [(n[-90:] if kind == tarfile.USTAR_FORMAT else n, c) for n, c in samples(1)]
    data = packed(members, kind)
    assert by_ranges(data, size) == plain(data)


@pytest.mark.parametrize("size", RANGES)
def test_ranges_inside_nested_archives(size):
    inner = packed(samples(2, 20))
    cut = inner[: len(inner) // 2 + 700]
    data = packed([("a.bin", b"x" * 3000), ("in.tar", inner), ("b.bin", b"y" * 700), ("cut.tar", cut), ("c.bin", b""), ("twice.tar", packed([("in.tar", inner)])), ("z", b"z")])
    found = by_ranges(data, size)
    # A range may lie wholly in a cut inner archive and claim too much; then the archive is walked as one.
    assert found is None or found == plain(data)
    assert by_ranges(data, len(data)) == plain(data)


def test_ranges_of_random_sizes():
    rng = np.random.default_rng(7)
    for seed in range(20):
        data = packed(samples(seed, 30), tarfile.PAX_FORMAT if seed % 2 else tarfile.GNU_FORMAT)
        assert by_ranges(data, 512 * int(rng.integers(1, 40))) == plain(data)


def listed(spark, folder):
    return archives.list_archives(spark, folder)


def test_many_archives_use_many_tasks(spark, workdir):
    for i in range(40):
        fx.tar(f"{workdir}/tars/{i:05d}.tar", {f"{i}-{j}.txt": b"x" * (50 * i) for j in range(3)})
    found = archives.index_archives(listed(spark, f"{workdir}/tars"))
    assert archives.byte_ranges(listed(spark, f"{workdir}/tars")).select(F.spark_partition_id()).distinct().count() == 8
    members = found.checkpoint()
    read = archives.read_members(members).select("member", F.length("content").alias("n"), F.spark_partition_id().alias("task")).collect()
    assert len(read) == 120 and len({r.task for r in read}) >= 8
    assert all(r.n == 50 * int(r.member.split("-")[0]) for r in read)


def test_one_archive_is_read_by_many_tasks(spark, workdir):
    data = packed(samples(3, 200))
    path = fx.write(f"{workdir}/tars/big.tar", data)
    given = listed(spark, f"{workdir}/tars")
    assert archives.byte_ranges(given, 16_384).rdd.getNumPartitions() >= 8
    found = archives.index_archives(given, 16_384).collect()
    assert sorted((r.member, r.offset, r.size) for r in found) == plain(data)
    # Without lengths, and named twice.
    again = spark.createDataFrame([(path,), (path,)], "archive string")
    assert archives.index_archives(again, 65_536).count() == len(found)


def test_nested_and_cut_archives(spark, workdir):
    inner = packed(samples(2, 40))
    data = packed([("a.bin", b"x" * 3000), ("cut.tar", inner[: len(inner) // 2 + 700]), ("b.bin", b"y" * 700), ("in.tar", inner), ("c", b"c")])
    fx.write(f"{workdir}/tars/1.tar", data)
    fx.write(f"{workdir}/tars/2.tar", packed(samples(5)))
    found = archives.index_archives(listed(spark, f"{workdir}/tars"), 4096).collect()
    assert sorted((r.member, r.offset, r.size) for r in found if r.archive.endswith("1.tar")) == plain(data)
    assert sorted((r.member, r.offset, r.size) for r in found if r.archive.endswith("2.tar")) == plain(packed(samples(5)))
    short = packed([("a", b"a" * 3000), ("b", b"b" * 9000)])[:6000]
    fx.write(f"{workdir}/short/3.tar", short)
    with pytest.raises(ValueError, match="too early"):
        archives.index_archives(listed(spark, f"{workdir}/short"), 2048)
    assert [r.member for r in archives.index_archives(listed(spark, f"{workdir}/short"), 2048, strict=False).collect()] == ["a"]


def test_labels(spark):
    names = ["/x/00012.tar", "/x/7.tar", "/x/set a.tar", "/x/1234567.tar"]
    got = spark.createDataFrame([(n,) for n in names], "p string").select(archives.archive_label(F.col("p"))).collect()
    assert [r[0] for r in got] == ["00012", "00007", "set_a", "1234567"]


def test_done_batches_count_once(spark, workdir):
    path = f"{workdir}/done"
    assert text.read_done(spark, path).count() == 0
    for batch, names in (("a-0", [(1, "1.tar")]), ("a-1", [(None, "x.tar"), (2, "2.tar")]), ("a-0", [(1, "1.tar")]), ("b-0", [(2, "2.tar")])):
        text.mark_done(spark.createDataFrame(names, "archive_id bigint, archive string"), path, batch)
    assert sorted(tuple(r) for r in text.read_done(spark, path).collect() if r[0]) == [(1, "1.tar"), (2, "2.tar")]
    assert text.read_done(spark, path).count() == 3


def test_next_archives_with_and_without_numbers(spark):
    config = ingest.IngestSettings("root", None)
    rows = [("/t/00003.tar", 3), ("/t/b.tar", None), ("/t/a.tar", None), ("/t/00001.tar", 1), ("/t/c.tar", None), ("/u/00003.tar", 3)]
    given = spark.createDataFrame(rows, "archive string, id bigint")
    done = spark.createDataFrame([("set_00001", 1), ("set_a", None)], "dataset string, id bigint")
    take = lambda n, mode="max": sorted(r.archive for r in ingest.next_archives(given, done, config, n, mode).collect())
    assert take(1) == ["/t/00003.tar", "/u/00003.tar"]
    assert take(2) == ["/t/00003.tar", "/t/b.tar", "/u/00003.tar"]
    assert take(9, "gaps") == ["/t/00003.tar", "/t/b.tar", "/t/c.tar", "/u/00003.tar"]


def test_ingest_of_archives_without_a_number(spark, workdir):
    from corpusmill.operators import models

    config = ingest.IngestSettings(f"{workdir}/store", models.block_average(), fx.read_png, image_size=16, batch_size=4, shard_size=3, limits={"min_side": 16})
    fx.archive(f"{workdir}/tars/some set.tar", 10)
    fx.tar(f"{workdir}/tars/empty.tar", {"a.txt": b"no image"})
    run = lambda: sorted((r.dataset, r.n) for r in ingest.ingest_next(spark, f"{workdir}/tars", config, 5, done=f"{workdir}/done").collect())
    assert run() == [("set_some_set", 4)]
    assert run() == [] and text.read_done(spark, f"{workdir}/done").count() == 2
    sizes = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{workdir}/store/shards") for f in names if f.endswith(".parquet"))
    from corpusmill.sources import shards

    assert [tuple(r) for r in shards.dataset_sizes(spark, config.root, ["set_some_set", "none"]).collect()] == [("set_some_set", sizes)]

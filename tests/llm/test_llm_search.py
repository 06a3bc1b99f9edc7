"""SimHash groups, ranked search and importance resampling against plain versions, and on odd input."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusmill.llm import importance, ranked_search, simhash_groups, vantage_tree

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, id string, n bigint, score string, item string, print string, cell int, part string"


def _row(i, text):
    return (i, text, "id", 7, "s", "t", "p", 1, "x")


PROSE = " ".join(f"word{i}" for i in range(60))
ROWS = [
    _row(1, PROSE), _row(2, PROSE), _row(2, PROSE), _row(3, PROSE + " more"), _row(4, None), _row(5, ""), _row(None, PROSE), _row(None, None),
    _row(6, "Éa " * 70_000), _row(7, " \n\t "), _row(8, "two words"), _row(9, "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_print(text, size=3):
    words = SPACED.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(points, reach=3):
    label = np.arange(len(points))
    while True:
        least = np.array([label[np.bitwise_count(points ^ p) <= reach].min() for p in points])
        if (least == label).all():
            return label
        label = least


def _points(seed, n, clusters):
    """Random fingerprints, and around some of them chains and clouds of a few changed bits."""
    rng = np.random.default_rng(seed)
    points = [rng.integers(0, 2**64, n, dtype=np.uint64)]
    for centre in points[0][:clusters]:
        flips = np.uint64(1) << rng.integers(0, 64, (40, 4)).astype(np.uint64)
        points.append(centre ^ np.bitwise_or.reduce(flips, axis=1))
        points.append(np.bitwise_xor.accumulate(np.concatenate([[centre], flips[:, 0] | flips[:, 1]])))
    return np.unique(np.concatenate(points))


def _same(a, b):
    return len(set(zip(a.tolist(), b.tolist()))) == len(set(a.tolist())) == len(set(b.tolist()))


@pytest.mark.parametrize("leaf", [8, 64, 5000])
def test_forest_finds_all_links(leaf):
    points = _points(3, 800, 6)
    assert _same(vantage_tree.forest(points, 3, leaf), plain_groups(points))


def test_forest_of_one_dense_group():
    rng = np.random.default_rng(5)
    flips = np.uint64(1) << rng.integers(0, 64, (4000, 5)).astype(np.uint64)
    points = np.unique(np.uint64(12345) ^ np.bitwise_or.reduce(flips, axis=1))
    assert _same(vantage_tree.forest(points, 3, 100), plain_groups(points))


def test_every_close_pair_meets_in_a_cell():
    points = _points(4, 3000, 10)
    tree = vantage_tree.build(points[::3], 20, 3)
    cells, at = vantage_tree.route(tree, points, 3)
    assert tree.cells > 10 and set(at.tolist()) == set(range(len(points)))
    held = [set(at[cells == c].tolist()) for c in range(tree.cells)]
    close = np.argwhere(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3, 1))
    assert len(close) > 500
    assert all(any(a in h and b in h for h in held) for a, b in close.tolist())


@pytest.mark.parametrize(("cell", "block"), [(100, 10_000), (40, 50), (10_000, 200)])
def test_links_dealt_by_cells_and_blocks(spark, cell, block):
    points = _points(6, 1500, 5)
    classes = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "print bigint").repartition(4)
    edges = simhash_groups.links(classes, cell=cell, block=block).collect()
    index = {int(x): i for i, x in enumerate(points.view(np.int64))}
    sets = vantage_tree._Sets(len(points))
    for a, b in edges:
        sets.unite(np.array([index[a], index[b]]))
    assert _same(sets.find(np.arange(len(points))), plain_groups(points))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_simhash_query(spark, folder):
    path = f"/root/testdata/{folder}"
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in entry.queries()["op11_simhash_near_dedup"](spark, path).collect()}
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect())
    prints = [plain_print(t) for _, t in rows]
    label = plain_groups(np.array(prints, dtype=np.uint64))
    assert found == {i: (f"{p:016x}", rows[g][0]) for (i, _), p, g in zip(rows, prints, label.tolist())}


def test_simhash_groups(docs, nothing):
    found = simhash_groups.similar_groups(docs).collect()
    assert len(found) == len(ROWS)
    assert sorted((r["id"] or 0, r["print"]) for r in found) == sorted((r[0] or 0, int(np.uint64(plain_print(r[1])).view(np.int64))) for r in ROWS)
    by = {r["id"]: r["component_id"] for r in found if r["id"]}
    assert by[1] == by[2] == 1 and by[4] == by[5] == by[7] == 4 and by[6] == 6 and by[8] == 8
    assert sorted(r["component_id"] for r in found if r["id"] is None) == [1, 4]
    kept = simhash_groups.one_of_each(docs)
    assert kept.columns == docs.columns and {1, 4, 6, 8, 9} <= {r["doc_id"] for r in kept.collect()}
    assert simhash_groups.similar_groups(nothing).count() == 0


def test_simhash_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97} x{i % 31}" for i in range(500))
    whole = simhash_groups.fingerprint(text.encode())
    monkeypatch.setattr(simhash_groups, "_PART", 7)
    assert whole == simhash_groups.fingerprint(text.encode()) == plain_print(text)


def plain_search(docs, items, k):
    words = [(i, PLAIN.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(PLAIN.findall((t or "").translate(LOWER)))
    out = []
    for item, held in terms.items():
        scores = []
        for i, w in words:
            tf = Counter(w)
            m = 10 + 90 * len(w) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in held if t in tf)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [
    (1, "word1 word2 WORD3, word4"), (2, "word1 word2 word3 éa"), (3, "word1; word2 word3 two"), (3, "a"), (4, None), (5, ""), (None, "word9 word10 two words"), (6, "absent"),
]


@pytest.mark.parametrize("postings", [1, 4, 100_000])
def test_search(spark, docs, postings):
    items = spark.createDataFrame([(*i, "t") for i in ITEMS], "item_id int, text string, term string")
    found = ranked_search.search(docs, items, k=3, postings=postings)
    assert dict(found.dtypes) == {"item": "int", "rank": "int", "id": "bigint", "score": "bigint"}
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_search([r[:2] for r in ROWS], ITEMS, 3)


def test_search_of_nothing(spark, docs, nothing):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert ranked_search.search(nothing, items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0


def test_search_narrow_blocks(spark, docs, monkeypatch):
    """Documents scored a few at a time, ties across blocks."""
    pairs = [(1, "w"), (2, "w"), (3, "v"), (4, "w")]
    rows = spark.createDataFrame([(i, text) for i, text in zip(range(50, 0, -1), ["w x", "w x", "v y"] * 17)], "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(ranked_search, "_CELLS", 9)
    items = spark.createDataFrame(pairs, "item_id int, text string")
    found = sorted(tuple(r) for r in ranked_search.search(rows, items, k=4).collect())
    assert found == plain_search([tuple(r) for r in rows.collect()], pairs, 4)


def test_sharing_plan():
    rng = np.random.default_rng(2)
    items = [sorted(rng.choice(40, size=rng.integers(0, 25), replace=False).tolist()) for _ in range(30)] + [[0, 1, 2, 3, 4, 5]] * 4
    plan = ranked_search.sharing_plan(items, 41)
    value = rng.integers(0, 1000, 41)
    held = np.zeros(plan.nodes, dtype=np.int64)
    np.add.at(held, plan.atom[sorted({t for i in items for t in i})], value[sorted({t for i in items for t in i})])
    for level in plan.sums:
        held[level[:, 0]] = held[level[:, 1]] + held[level[:, 2]]
    assert [int(held[nodes].sum()) for nodes in plan.items] == [int(value[i].sum()) for i in items]
    assert plan.additions < sum(max(0, len(i) - 1) for i in items)
    assert ranked_search.sharing_plan([], 0).nodes == 0


def plain_draw(docs, target, longest, buckets, percent, least):
    def features(text):
        w = PLAIN.findall((text or "").translate(LOWER))
        return len(w), [crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    source = Counter(b for _, t in docs for b in features(t)[1])
    aim = Counter(b for t in target for b in features(t)[1])
    s_all, t_all = sum(source.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, t in docs:
        n_words, found = features(t)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    fit = sorted((k for k, r in enumerate(rows) if r[4] >= least), key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    rank = {k: r for r, k in enumerate(fit[: percent * len(fit) // 100], 1)}
    return sorted(((*r[:4], rank.get(k)) for k, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("longest", "percent", "least"), [(2, 50, 1), (1, 60, 0), (1, 100, 0)])
def test_resampled(spark, docs, longest, percent, least):
    target = [r[1] for r in ITEMS]
    items = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    found = importance.resampled(docs, items, longest=longest, buckets=500, percent=percent, least_words=least)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_draw([r[:2] for r in ROWS], target, longest, 500, percent, least)


def test_resampled_with_ties(spark):
    """Equal scores: one id over and over, then the rows of one id that differ in length."""
    rows = [(i % 7, " ".join(["a"] * (i % 3 + 1))) for i in range(-40, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    target = spark.createDataFrame([("b",)], "text string")
    for percent in (13, 99):
        found = importance.resampled(docs, target, buckets=50, percent=percent, least_words=0)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_draw(rows, ["b"], 1, 50, percent, 0)


def test_resampled_of_nothing(spark, docs, nothing):
    assert importance.resampled(nothing, docs).count() == 0
    assert importance.resampled(docs, nothing, percent=100, least_words=0).where("rank is not null").count() == len(ROWS)


@pytest.mark.parametrize("above", [True, False])
def test_bisection(spark, above):
    values = [-5, -5, 0, 1, 1, 1, 9, 1000, 1001, 10**12]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    ordered = sorted(values, reverse=above)
    for wanted in (1, 2, 3, 5, 9, 10):
        assert importance._bisect(rows, "v", wanted, above) == ordered[wanted - 1]


def test_features_in_blocks(monkeypatch):
    import pyarrow as pa

    column = pa.array(["a b c", None, "d", "", "e f g h", "i"])
    monkeypatch.setattr(importance, "_BLOCK_WORDS", 2)
    parts = list(importance._features(column, 1, 1000))
    assert [p[0] for p in parts] == [0, 1, 5] and np.concatenate([p[1] for p in parts]).tolist() == [3, 0, 1, 0, 4, 1]
    assert np.concatenate([p[3] for p in parts]).tolist() == [crc32(x) % 1000 for x in b"a b c d e f g h i".split()]


def test_gumbel_of_ids(spark):
    rows = spark.range(3).select(importance.gumbel(F.col("id"), 2024).alias("g")).collect()
    want = [math.floor(-1000 * math.log(-math.log((int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32))) for i in range(3)]
    assert [r["g"] for r in rows] == want

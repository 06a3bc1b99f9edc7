"""Every registered query of the subpackage against its SQL, or against a brute-force version, on the smallest tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from html import unescape

import duckdb
import pytest
from compare import differences, oracle

import __spark_entry__ as entry
from corpusmill.llm.registry import ORACLE

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def given(sf_dir: str, sql: str) -> list[tuple]:
    return duckdb.sql(sql.format(d=sf_dir)).fetchall()


def find_groups(rows, size, percent=80):
    """Number of shingles and least id reachable of each document, by counting shared shingles of all pairs."""
    sets, parent, holders = {}, {}, defaultdict(list)
    for i, text in rows:
        w = SPACED.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = Counter(m for g in s for m in holders[g])
        for g in s:
            holders[g].append(i)
        for m, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[m]) - n):
                a, b = find(i), find(m)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def cut_repeats(rows, length=100):
    """Bytes, removed bytes, spans and digest of what is left of each document, by a set of all strings."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            key = hashlib.md5(raw[p : p + length]).digest()
            if key in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(key)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m[0])) <= 15),
)
SECRET = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def base_of(kinds, text: str) -> list[str]:
    found = sorted((m.start(), k, name, m.end()) for k, (name, pattern, keep) in enumerate(kinds) for m in re.finditer(pattern, text) if keep(m))
    return [f"{name}:{a}:{b}" for a, _, name, b in found]


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n in ORACLE))
def test_sql(spark, sf_dir, name):
    assert differences(entry.queries()[name](spark, sf_dir), oracle(sf_dir), ORACLE[name]) == []


def test_near_duplicates(spark, sf_dir):
    want = find_groups(given(sf_dir, "select doc_id, text from '{d}/documents.parquet'"), 4)
    got = {r["doc_id"]: r for r in entry.queries()["op10_minhash_near_dedup"](spark, sf_dir).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_repeats(spark, sf_dir):
    want = cut_repeats(given(sf_dir, "select doc_id, text from '{d}/documents.parquet'"))
    got = {r[0]: tuple(r)[1:] for r in entry.queries()["op2_suffix_dedup"](spark, sf_dir).collect()}
    assert got == want


@pytest.mark.parametrize(("name", "kinds"), [("op4_secret_scan", SECRET), ("op8_pii", PERSONAL)])
def test_spans(spark, sf_dir, name, kinds):
    got = {r["doc_id"]: r for r in entry.queries()[name](spark, sf_dir).collect()}
    rows = given(sf_dir, "select doc_id, text from '{d}/documents.parquet'")
    assert len(got) == len(rows)
    for i, text in rows:
        base = base_of(kinds, text or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[i]["spans"].split(",")) or not base
        for kind, _, _ in kinds:
            assert got[i][f"n_{kind}"] == sum(s.startswith(kind + ":") for s in base)


def test_main_texts(spark, sf_dir):
    got = {r["page_id"]: r for r in entry.queries()["op1_html_extraction"](spark, sf_dir).collect()}
    for page, html in given(sf_dir, "select page_id, html from '{d}/pages.parquet'"):
        body = re.search(r"<article>(.*?)</article>", html, re.DOTALL)[1]
        parts = [" ".join(unescape(re.sub("</?b>", "", p).replace("<br>", " ")).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert got[page]["text"] == "\n\n".join(p for p in parts if p)
        assert got[page]["n_chars"] == len(got[page]["text"])


def test_quality_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in entry.queries()["op3_quality_gam"](spark, sf_dir).collect()}
    held = [(got[i]["predicted"], y) for i, y in given(sf_dir, "select doc_id, quality from '{d}/labels.parquet'") if got[i]["held_out"]]
    assert len(held) > 40 and sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_mix_is_near_its_targets(spark, sf_dir):
    rows = entry.queries()["op5_mixing"](spark, sf_dir).collect()
    source = dict(given(sf_dir, "select doc_id, source from '{d}/documents.parquet'"))
    taken, target, longest = Counter(), {}, Counter()
    for r in rows:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        target[s], longest[s] = r["target"], max(longest[s], r["size"])
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 3 * longest[s] for s in target)


def test_pipeline(spark, sf_dir):
    """All stages keep what they should: no failed rule, one of each group, no benchmark window, no base span left."""
    import corpus_pipeline

    found = corpus_pipeline.run(spark, sf_dir)
    assert set(found.columns) == {"doc_id", "text", "lang", "source", "n_chars", "copy"}
    rows = {r["doc_id"]: r for r in found.collect()}
    docs = dict(given(sf_dir, "select doc_id, text from '{d}/documents.parquet'"))
    groups = find_groups([(i, docs[i]) for i in rows], 5)
    assert all(g == i for i, (_, g) in groups.items())
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for (text,) in given(sf_dir, "select text from '{d}/benchmark.parquet'"):
        w = word.findall((text or "").translate(LOWER))
        windows |= {tuple(w[j : j + 10]) for j in range(len(w) - 9)}
    for i, r in rows.items():
        w = word.findall(docs[i].translate(LOWER))
        assert not windows & {tuple(w[j : j + 10]) for j in range(len(w) - 9)}
        assert base_of(PERSONAL, r["text"]) == [] and r["n_chars"] == len(r["text"])

"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names for every operator of the subpackage."""

from __future__ import annotations

import argparse
import asyncio
import collections
import datetime
import email.message
import hashlib
import http.server
import inspect
import logging.handlers
import os
import random
import re
import socket
import ssl
import string
import tarfile
import threading
import time
import unittest
import urllib.request

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import boosted_trees, decontamination, main_text, mixing, native, near_duplicates, personal_data, quality_model, quality_rules, repeats, secrets, spans, warc
from corpusmill.llm.components import components

SCHEMA = "doc_id bigint, text string, source string, id string, tie string, row string, quality string, label string, band string, size string"
PROSE = "the house and the garden of a man is on the hill with water from " + " ".join(f"word{i}x" for i in range(60))


def _row(i, text, source="s"):
    return (i, text, source, "id", "tie", "row", "q", "l", "b", "z")


ROWS = [
    _row(1, PROSE), _row(2, PROSE), _row(2, PROSE), _row(3, PROSE + " more"), _row(4, None), _row(5, ""), _row(None, PROSE), _row(None, None, None),
    _row(6, "a" * 50_000), _row(7, " \n\t "), _row(8, "x " * 20_000), _row(9, "mail a@b.co or 4111 1111 1111 1111 and +1 (131) 555-7634", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_rules(docs, nothing):
    kept = quality_rules.kept_rows(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 2, 3, 9]
    by = {r["doc_id"]: r for r in quality_rules.judged(docs.drop("quality")).collect()}
    assert by[4]["quality"]["n_words"] == 0 and not by[4]["kept"] and by[8]["quality"]["n_repeat_words"] == 20_000
    assert quality_rules.kept_rows(nothing).count() == 0


def test_stop_words(spark):
    """Punctuation does not hide a stop word, and a text under 100 words may do without any."""
    texts = ["stone " * 4 + " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(99)) + ' "The,"']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r["doc_id"]: r["failed_rules"] for r in quality_rules.judged(docs).collect()} == {0: [], 1: ["no_stop_words"], 2: []}
    assert {r["doc_id"] for r in quality_rules.kept_rows(docs).collect()} == {0, 2}


def test_near_duplicates(docs, nothing):
    found = near_duplicates.near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    groups = {r["id"]: r["component_id"] for r in found if r["n_shingles"]}
    assert groups[1] == groups[2] == groups[3] == groups[None] == 1
    assert groups[6] == 6 and groups[8] == 8 and groups[9] == 9
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9]
    assert near_duplicates.one_of_each(nothing).count() == 0


def test_near_duplicates_in_large_buckets(spark):
    """A chain of variants around the threshold: groups by exact comparison of all pairs."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for j in range(i % 12):
            words[(i * 7 + j * 16) % 200] = f"other{i}-{j}"
        rows.append((i, " ".join(words)))
    got = {r["id"]: r["component_id"] for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(196)} for i, t in rows}
    want = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and want[a] != want[b]:
                    want[a] = want[b] = min(want[a], want[b])
                    changed = True
    assert got == want


@pytest.mark.parametrize("few", [0, 1000])
def test_components(spark, few):
    edges = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (98, 98), (200, 300), (300, 200)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5), few=few).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((98, 99, 100), 98), **dict.fromkeys((200, 300), 200)}


def test_repeats(docs, nothing):
    by = {}
    for r in repeats.repeats(docs, keep_text=True).collect():
        by.setdefault(r["id"], []).append(r)
    whole = len(PROSE)
    assert {r["n_removed"] for r in by[None]} == {0}  # a NULL id comes first
    assert by[1][0]["n_removed"] == whole and [r["n_removed"] for r in by[2]] == [whole, whole]
    assert by[3][0]["kept_text"] == " more"
    assert by[6][0]["n_removed"] == 49_999 and by[8][0]["n_removed"] == 39_998
    assert by[4][0]["kept_sha256"] == by[5][0]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert repeats.repeats(nothing).count() == 0


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame(
        [(1, " ".join(PROSE.split()[20:32]), "t"), (1, " ".join(PROSE.split()[20:32]), "t"), (2, "Mail A", "t"), (3, None, "t"), (4, "", "t"), (None, "b.co", "t")],
        "item_id bigint, text string, tie string",
    )
    rows = decontamination.hits(docs, items).collect()
    assert len(rows) == len(ROWS)
    by = {r["id"]: r for r in rows}
    assert by[1]["n_hit"] == 12 and by[1]["items"] == ["1"]
    assert by[9]["items"] == ["2"] and by[9]["n_hit"] == 4 and by[4]["n_hit"] == 0
    joined = {r["id"]: r for r in decontamination.hits(docs, items, max_windows=0).collect()}
    assert {i: (r["n_words"], r["n_hit"], r["items"]) for i, r in joined.items()} == {i: (r["n_words"], r["n_hit"], r["items"]) for i, r in by.items()}
    clean = decontamination.cleaned(docs, items)
    assert clean.columns == docs.columns and sorted(r["doc_id"] or 0 for r in clean.collect()) == [0, 4, 5, 6, 7, 8]
    cut = {r["doc_id"]: r["text"] for r in decontamination.without_spans(docs, items).collect()}
    assert cut[4] is None and "word10x" not in cut[1] and cut[1].endswith("word59x")
    assert decontamination.cleaned(docs, items.limit(0)).count() == len(ROWS)
    assert decontamination.hits(nothing, items).count() == 0


def test_spans_of_the_joined_form(spark, docs, nothing):
    """Large benchmarks cut the same bytes as small ones."""
    items = spark.createDataFrame([(1, " ".join(PROSE.split()[20:32])), (2, "Mail A"), (3, "élan vital"), (None, "b.co")], "item_id bigint, text string")
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(20, "né, Élan (élan) vital! élan vital été"), (21, None), (None, "élan-vital")], "doc_id bigint, text string"))
    ordered = lambda rows: sorted(map(str, rows.collect()))
    assert ordered(decontamination.hits(more, items, max_windows=0)) == ordered(decontamination.hits(more, items))
    cut = decontamination.without_spans(more, items, max_windows=0)
    assert ordered(cut) == ordered(decontamination.without_spans(more, items))
    assert "élan vital" not in "".join(r["text"] or "" for r in cut.collect())
    assert decontamination.without_spans(nothing, items, max_windows=0).count() == 0


def test_personal_data(docs, nothing):
    chooser = personal_data.train(docs)
    found = {r["row"]["doc_id"]: r for r in personal_data.with_spans(docs, chooser).collect()}
    assert [s["kind"] for s in found[9]["base_spans"]] == ["email", "card", "phone"]
    clean = personal_data.redacted(docs, chooser)
    assert clean.columns == docs.columns
    by = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert by[9] == "mail [EMAIL] or [CARD] and [PHONE]" and by[4] is None and by[5] == "" and by[6] == "a" * 50_000
    assert personal_data.redacted(nothing, personal_data.train(nothing)).count() == 0


def test_chosen_candidates(spark):
    """Candidates over the least score are added where they overlap no base span, each generator after the other."""
    rows = [(i, f"call the office tel: (030) 555-12{i % 90 + 10} or write to me") for i in range(200)] + [(1000 + i, f"a +1 (131) 555-76{i % 90 + 10} b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    x = np.array([[20, 10, 0, 0, 1, 0, 1, 2, 0, 1, 0, 2, 2, 4], [20, 10, 0, 0, 1, 0, 1, 2, 0, 0, 0, 2, 2, 4]] * 20, dtype=float)
    model = boosted_trees.fit(x, np.array([1.0, 0.0] * 20))
    found = personal_data.with_spans(docs, personal_data.Chooser({"number": model, "address": model}, {"number": 0.0, "address": 0.0})).collect()
    assert all([s["kind"] for s in r["spans"]] == (["number"] if r["row"]["doc_id"] < 1000 else ["phone"]) for r in found)
    trained = personal_data.train(docs, max_rows=400)
    assert personal_data.with_spans(docs, trained).count() == 400


def _account(i):
    """A valid account number."""
    body = f"{370400440532000000 + 7919 * i}"
    return f"DE{98 - int(body + '131400') % 97:02d}{body}"


def test_valid_accounts_are_always_added(spark):
    """However few there are, and beside a base span too; rare candidates have a sample of their own."""
    few = spark.createDataFrame([(1, f"pay {_account(1)} now"), (None, f"pay {_account(2)} now"), (3, "pay GB29 NWBK 6016 1331 9268 19 now"), (4, "pay DE00370400440532000000 now")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in personal_data.redacted(few, personal_data.train(few)).collect()}
    assert got == {1: "pay [ACCOUNT] now", None: "pay [ACCOUNT] now", 3: "pay [ACCOUNT] now", 4: "pay DE00370400440532000000 now"}
    many = spark.createDataFrame([(i, f"order {1000000 + i} is done") for i in range(3000)] + [(5000 + i, f"pay {_account(i)} now") for i in range(300)], "doc_id bigint, text string")
    assert "account" in personal_data.train(many, max_rows=300).models


def test_candidates_outside_base_spans(spark):
    """Written-out addresses are confirmed by normalising, numbers learned from their context, beside base spans that are not."""
    texts = {
        1: ("mail jane [at] example [dot] com. We wait", "mail [ADDRESS]. We wait"), 2: ("mail jane at example dot com", "mail [ADDRESS]"),
        3: ("mail jane @ mail.example.com or a@b.co", "mail [ADDRESS] or [EMAIL]"), 4: ("look at home. He has 3 apples @ 1.50 (at) a.b", "look at home. He has 3 apples @ 1.50 (at) a.b"),
    }
    rows = [(i, a) for i, (a, _) in texts.items()] + [(100 + i, f"tel: (030) 555-12{i % 90 + 10} or") for i in range(300)]
    rows += [(1000 + i, f"a +1 (131) 555-76{i % 90 + 10} b") for i in range(300)] + [(2000 + i, f"invoice {100000000000 + 9973 * i} b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in personal_data.redacted(docs, personal_data.train(docs)).collect()}
    assert {i: got[i] for i in texts} == {i: b for i, (_, b) in texts.items()}
    assert all(got[100 + i] == "tel: [NUMBER] or" and got[1000 + i] == "a [PHONE] b" and "[NUMBER]" not in got[2000 + i] for i in range(300))


def test_numbers_of_planted_people(spark):
    """Local numbers of three formats are learned from those with a word for them, and found without one; other numbers are left alone."""
    r = random.Random(5)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    people = (lambda: f"(0{d(2)}) {d(3)}-{d(4)}", lambda: f"0{d(3)} {d(3)} {d(2)} {d(2)}", lambda: f"{d(3)}-{d(2)}-{d(4)}")
    things = (lambda: f"20{d(2)}/{d(6)}", lambda: f"{d(8)}", lambda: f"20{d(2)}-0{r.randint(1, 9)}-1{d(1)}", lambda: f"1.{d(3)}.{d(3)}.{d(3)}0")
    rows = [(i, f"{r.choice(['tel: ', 'contact ', 'phone '])}{r.choice(people)()} or so") for i in range(600)]
    rows += [(1000 + i, f"{r.choice(['invoice ', 'order ', 'then ', 'of '])}{r.choice(things)()} or so") for i in range(900)]
    rows += [(2000 + i, f"then {r.choice(people)()} or so") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {x["row"]["doc_id"] for x in personal_data.with_spans(docs, personal_data.train(docs)).collect() if any(s["kind"] == "number" for s in x["spans"])}
    right = {i for i in found if i < 1000 or i >= 2000}
    assert len(right) >= 0.9 * 620 and len(right) >= 0.95 * len(found)
    assert len([i for i in found if i >= 2000]) >= 18


def test_candidates_are_all_fitted_on(spark):
    """Trees and thresholds come from all candidates, however few of them may come to the driver."""
    r = random.Random(7)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    cue = lambda often, seldom: r.choice([often] * 40 + [seldom])
    rows = [(i, f"{cue('tel: ', 'then ')}0{d(3)} {d(r.randint(3, 5))} {d(2)} or so") for i in range(400)]
    rows += [(1000 + i, f"{cue('order ', 'tel: ')}20{d(2)}/{d(r.randint(4, 8))} or so") for i in range(400)] + [(1000 + i, "pay 1234567 now") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    whole = personal_data.train(docs)
    assert "number" in whole.least and personal_data.train(docs, max_rows=0) == whole
    assert personal_data._kinds(docs.union(docs), "doc_id", "text").agg(F.sum("n")).first()[0] == 809


def test_redaction_of_overlaps(spark):
    one = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(r).alias("rank"), F.lit(b).alias("end"), F.lit(k).alias("kind")) for a, r, b, k in ((2, 0, 6, "ip"), (4, 1, 8, "card"), (8, 1, 9, "card"))])
    assert spark.range(1).select(spans.replaced(F.lit("0123456789é"), one)).first()[0] == "01[IP][CARD]9é"


def test_secrets(spark, sf_dir, nothing):
    table = secrets.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert secrets.with_spans(nothing, secrets.train(nothing)).count() == 0
    rows = spark.createDataFrame(
        [(1, "key Zk3vQ9xT7bR2mW8yLp4nD6sH1jF5 here"), (2, "the_house_and_garden_of_words12 here"), (3, 'Token: "abcdef1" x'), (4, None), (5, "f" * 100_000)], "doc_id bigint, text string"
    )
    found = {r["row"]["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.with_spans(rows, table).collect()}
    assert found == {1: ["random"], 2: [], 3: ["assign"], 4: [], 5: ["hex"]}


def test_secrets_count_all_documents(spark):
    """Pairs of identifiers are counted in every document, however many there are and whatever their ids."""
    docs = spark.range(30_000).selectExpr("nullif(id, 7) as doc_id", "'zqzqzq' as text")
    one = lambda n: spark.createDataFrame([(1, "zqzqzq " * n)], "doc_id bigint, text string")
    got = secrets.train(docs, random_rows=0)
    assert got == secrets.train(one(30_000), random_rows=0) != secrets.train(one(29_999), random_rows=0)


def _identifiers():
    """Names of Python's own modules and classes, as identifiers that people wrote."""
    found = set()
    for module in (argparse, asyncio, collections, datetime, email.message, http.server, inspect, logging.handlers, os, socket, ssl, tarfile, threading, unittest, urllib.request):
        for name in dir(module):
            thing = getattr(module, name)
            found |= {name, *(dir(thing) if isinstance(thing, type) else ())}
    return sorted({n.strip("_") for n in found if re.fullmatch("[A-Za-z_]{6,}", n.strip("_"))}, key=lambda n: hashlib.md5(n.encode()).digest())


def test_secrets_of_held_out_strings(spark):
    """Trained on half of the names: planted random tokens are found, joined names with numbers from the other half are left alone."""
    names, r = _identifiers(), random.Random(7)
    known, held = names[: len(names) // 2], names[len(names) // 2 :]
    model = secrets.train(spark.createDataFrame([(i, " ".join(known[i : i + 20])) for i in range(0, len(known), 20)], "doc_id bigint, text string"))
    alphabets = [string.ascii_letters + string.digits + x for x in ("", "+/", "-_")] + [string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits]
    planted = ["".join(r.choice(a) for _ in range(n)) for a in alphabets for n in (16, 20, 24, 32, 40) for _ in range(100)]
    planted = [s for s in planted if re.search("[0-9]", s) and re.search("[A-Za-z]", s)]
    joined = [r.choice("_-/").join(r.choice(held) for _ in range(r.randint(1, 4))) + r.choice(["", "_", "v"]) + str(r.randint(0, 9999)) for _ in range(4_000)]
    rows = spark.createDataFrame([(i, f"see {s} now") for i, s in enumerate(planted + joined)], "doc_id bigint, text string")
    found = {x["row"]["doc_id"]: (x["spans"][0]["start"], x["spans"][0]["end"]) for x in secrets.with_spans(rows, model).collect() if x["spans"]}
    right = [i for i, s in enumerate(planted) if found.get(i) == (4, 4 + len(s))]
    assert len(right) >= 0.96 * len(planted)
    assert len(right) >= 0.99 * len(found) and len(found) - len(right) <= 4


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 128, 129, 1000])
def test_running_and_overlaps(spark, size):
    """Blocks join up, positions count code points, and the binary search finds what a plain loop finds."""
    found = [(3 * i % 997, 0, 3 * i % 997 + i % 5 + 1, "x") for i in range(size)]
    asked = [(a, a + n) for a in range(0, 1010, 7) for n in (1, 4)]
    rows = spark.createDataFrame([(found, asked, "é😀 " + "ab12 " * size)], f"found {spans.TYPE}, asked array<struct<start:int,end:int>>, text string")
    shade = lambda s: F.transform("asked", lambda m: spans.overlaps(m, s))
    got = rows.select(
        native.running(F.transform("found", lambda x: x["end"]), lambda a, b: a + b).alias("sums"), native.let(spans.shadow(F.col("found")), shade).alias("over"),
        native.matches(F.col("text"), "[0-9]+").alias("at"), spans.replaced(F.col("text"), F.col("found")).alias("cut"),
    ).first()
    assert got["sums"] == list(np.cumsum([x[2] for x in found]))
    assert got["over"] == [any(a < end and start < b for start, _, end, _ in found) for a, b in asked]
    assert [tuple(m) for m in got["at"]] == [(5 + 5 * i, 7 + 5 * i, "12") for i in range(size)]
    want, at = "", 0
    text = "é😀 " + "ab12 " * size
    for start, _, end, _ in sorted(found):
        want += text[at:start] + "[X]" if start >= at else ""
        at = max(at, end)
    assert got["cut"] == want + text[at:]


def test_texts_full_of_matches(spark):
    """A text of 1 MB with 50,000 matches takes seconds: no step costs matches times length."""
    ips = " ".join(f"10.{i % 250}.{i // 250}.7 aaaaaaaa" for i in range(50_000))
    keys = " ".join(f"token=abcdef{i} b" for i in range(50_000))
    docs = spark.createDataFrame([(1, ips), (2, keys), (3, "Q7" * 500_000)], "doc_id bigint, text string")
    begin = time.monotonic()
    clean = {r["doc_id"]: r["text"] for r in personal_data.redacted(docs, personal_data.Chooser({}, {})).collect()}
    assert clean == {1: " ".join(["[IP] aaaaaaaa"] * 50_000), 2: keys, 3: "Q7" * 500_000}
    found = {r["row"]["doc_id"]: len(r["spans"]) for r in secrets.with_spans(docs, secrets.Model([0.0] * 94 * 94)).collect()}
    assert found == {1: 0, 2: 50_000, 3: 0}
    assert time.monotonic() - begin < 60


def test_quality_model(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (6, 0, 0), (77, 0, 0), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality_model.train(docs, labels)
    rows = quality_model.scored(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_model.scored(nothing, model).count() == 0
    assert [r["score"] for r in quality_model.scored(docs, quality_model.train(docs, labels.limit(0))).limit(1).collect()] == [0.5]


def test_mixing(docs, nothing):
    rows = mixing.with_copies(docs).collect()
    assert len(rows) == len(ROWS) and all(r["copies"] <= 3 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.with_copies(docs.repartition(3)).collect()))
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "copy"]
    assert out.count() == sum(r["copies"] for r in rows)
    assert mixing.mixed(nothing).count() == 0


LONG = "A long sentence, with commas, that reads like part of an article and goes on for a while, as they do."
LINKS = "<li><a href=a>Source one</a><li><a href=b>Source two</a><li><a href=c>Source three</a>"
# Pages and their blocks; P is the long sentence. Most have no article element.
LAYOUTS = {
    "title and lead beside the box": ("<div id=logo>Acme</div><div><h1>T</h1><p>Short lead.</p><div><p>P</p><p>P</p></div></div><div>© 2020 Acme</div>", "T|Short lead.|P|P"),
    "two sections": ("<div><h1>T</h1><section><h2>A</h2><p>P</p><p>P</p></section><section><h2>B</h2><p>Short end.</p></section></div>", "T|A|P|P|B|Short end."),
    "title further up": ("<h1>T</h1><p>Lead here.</p><p>12 May</p><div><div><p>P</p><p>P</p></div></div><p>© 2020 Acme. All rights.</p>", "T|Lead here.|P|P"),
    "two titles further up": ("<h1>Acme</h1><h1>Shop</h1><div><div><p>P</p><p>P</p></div></div>", "P|P"),
    "menu and comments": ("<ul><li><a>Home</a><li><a>News</a><li><a>About</a></ul><div><h2>T</h2><p>P</p><p>P</p></div><div class='comment-body'><p>P</p></div>", "T|P|P"),
    "linked title": ("<div><h1><a href=x>Acme</a></h1><div><p>P</p><p>P</p></div></div>", "P|P"),
    "bare divs": ("<div><h1>T</h1><div>P</div><div>P</div><div>P</div></div><div class=sidebar>P</div>", "T|P|P|P"),
    "main": ("<main><h1>T</h1><p>P</p><p>Short.</p></main><footer>P</footer>", "T|P|Short."),
    "table": ("<div class=nav>P</div><table><tr><td><h1>T</h1><p>P</p><p>P</p></td></tr></table>", "T|P|P"),
    "definition list": ("<div><h1>T</h1><p>P</p><dl><dt>One<dd>First.</dl><p>P</p></div>", "T|P|One|First.|P"),
    "sources by their heading": (f"<div><h1>T</h1><p>P</p><p>P</p><h2>Sources</h2><ul>{LINKS}</ul></div>", "T|P|P|Sources|Source one|Source two|Source three"),
    "links without a heading": (f"<div><h1>T</h1><p>P</p><p>P</p><ul>{LINKS}</ul></div>", "T|P|P"),
    "links at the end of an article": (f"<article><h1>T</h1><p>P</p><ul>{LINKS}</ul></article>", "T|P|Source one|Source two|Source three"),
    "links at the head of an article": (f"<article><h1>T</h1><ul>{LINKS}</ul><p>P</p></article>", "T|P"),
    "more to read in an article": (f"<article><h1>T</h1><p>P</p><h2>Related</h2><ul>{LINKS}</ul></article>", "T|P|Related"),
    "doubtful classes": (
        "<article><h1>T</h1><p>P</p><p class='share-price'>EUR 12.40</p><blockquote class='quote alert-free'>Quote.</blockquote><div class='share-buttons'>Share</div>"
        "<div class='social-housing'><a href=a>Facebook</a> now</div><div class='cookie-price'>x</div><p>P</p></article>", "T|P|EUR 12.40|Quote.|P",
    ),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page, blocks = LAYOUTS[name]
    want = [LONG if block == "P" else block for block in blocks.split("|")]
    assert main_text.main_text("<html><body>" + page.replace(">P<", f">{LONG}<") + "</body></html>") == "\n\n".join(want)


def test_links_of_an_article_far_down():
    """Many lists and blocks are linear, and a title of many pieces is whole."""
    page = "<div><h1>" + "<b>a</b> " * 5_000 + f"</h1><div><p>{LONG}</p>" + f"<ul>{LINKS}</ul><p>{LONG}</p>" * 3_000 + "</div></div>"
    begin = time.monotonic()
    assert main_text.main_text(page).split("\n\n") == ["a " * 4_999 + "a"] + [LONG] * 3_001
    assert time.monotonic() - begin < 10


def test_main_text(spark):
    pages = spark.createDataFrame(
        [(1, None, "t", "x"), (1, "", "t", "x"), (2, "<p>One, two &amp; three, long enough to count<p>Next", "t", "x"), (3, "<div>" * 20_000 + "deep", "t", "x")],
        "page_id bigint, html string, text string, page string",
    )
    rows = main_text.extracted(pages).collect()
    assert sorted((r["page"]["page_id"], r["text"]) for r in rows) == [(1, ""), (1, ""), (2, "One, two & three, long enough to count\n\nNext"), (3, "deep")]
    assert main_text.extracted(pages.limit(0)).count() == 0
    page = """<body class="has-sidebar"><div id="menu"><a href=1>x</a></div><div id="content"><h2>T</h2>Direct text, with commas, and long enough.
      <ul><li>one<li>two</ul><form>name</form></div><div class="comments"><p>I think, that, this is a long reader comment.</p></div><div class=sidebar>a, b, c and more text here</div>"""
    assert main_text.main_text(page) == "T\n\nDirect text, with commas, and long enough.\n\none\n\ntwo"


@pytest.mark.parametrize("range_bytes", [97, 1 << 20])
def test_warc(spark, workdir, range_bytes):
    inner = "WARC/1.0\r\n\r\n" * 3
    rows = [(1, "http://a/ b", "same", "x"), (2, None, "same", "x"), (None, "u", "same", "x"), (3, "u", None, "x"), (4, "u", "", "x"), (5, "u", inner, "x"), (6, "u", "é" * 40_000, "x"), (6, "u", "é" * 40_000, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string").repartition(2)
    warc.write_archives(pages, f"{workdir}/w")
    found = warc.read_archives(spark, f"{workdir}/w", with_payload=True, range_bytes=range_bytes).collect()
    assert sorted((r["page"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found) == [
        (0, "revisit", 2, 4), (1, "revisit", 2, 4), (2, "response", None, 4), (3, "revisit", 4, 0), (4, "response", None, 0), (5, "response", None, len(inner)),
        (6, "response", None, 80_000), (6, "response", None, 80_000),
    ]
    assert {r["payload"].decode() for r in found if r["payload"]} == {"same", inner, "é" * 40_000}
    warc.write_archives(pages.limit(0), f"{workdir}/none")
    assert warc.read_archives(spark, f"{workdir}/none").count() == 0


def test_bitmaps_never_drop_a_similar_pair(spark):
    rng = np.random.default_rng(3)
    rows = []
    for size in (1, 3, 40, 400, 5000):
        for swapped in (0.0, 0.05, 0.11, 0.2, 0.5):
            a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            b = a.copy()
            n = round(size * swapped)
            b[:n] = rng.integers(0, 1 << 64, n, dtype=np.uint64)
            bits = [near_duplicates._bitmaps(x, np.zeros(len(x), dtype=np.int64), 1)[0].tolist() for x in (a, np.unique(b))]
            both = len(np.intersect1d(a, b))
            similar = 100 * both >= 80 * (len(a) + len(np.unique(b)) - both)
            rows.append((bits[0], len(a), bits[1], len(np.unique(b)), similar, size <= 400 and swapped == 0.5 and size > 3))
    pairs = spark.createDataFrame(rows, "x array<bigint>, m bigint, y array<bigint>, n bigint, similar boolean, far boolean")
    passes = near_duplicates._reachable(F.col("x"), F.col("m"), F.col("y"), F.col("n"), 80)
    got = pairs.select(passes.alias("passes"), "similar", "far").collect()
    assert all(r["passes"] for r in got if r["similar"])
    assert not any(r["passes"] for r in got if r["far"])

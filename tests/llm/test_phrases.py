"""Phrase sets, edits and likeness against brute force; edge cases of op12."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from labelweave.llm import phrases
from labelweave.llm.frames import documents

SF = "/root/testdata/sf0.001"


def parsed(data):
    known, at = set(), 0
    while at < len(data):
        n = 1
        while at + n < len(data) and data[at : at + n] in known:
            n += 1
        known.add(data[at : at + n])
        at += n
    return known


def mark(text, maker):
    return phrases._short(maker.lanes.least(sorted(parsed(text.encode())))) if text else b""


def edit(text, successor):
    k = len(text) // 3
    return text[: len(text) - k] + successor[:k]


@pytest.mark.parametrize("seed", range(30))
def test_fingerprints(seed):
    rng, maker = random.Random(seed), phrases.Fingerprints(64)
    a, b = ("".join(rng.choice("abcé") for _ in range(rng.randint(0, 300))) for _ in range(2))
    a = a * 5 if seed % 3 == 0 else a
    known = maker.read(a, len(a) // 3)
    data, edited = maker.edited(known, b)
    assert known.fingerprint == mark(a, maker)
    assert data == edit(a, b).encode() and edited == mark(edit(a, b), maker)


def test_likeness_estimates_the_overlap_of_phrases():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(900)]
    a, b = " ".join(words[:600]), " ".join(words[:400] + words[600:800])
    maker = phrases.Fingerprints(1024)
    x, y = parsed(a.encode()), parsed(b.encode())
    got = phrases.alike(maker.read(a).fingerprint, maker.read(b).fingerprint)
    assert got == pytest.approx(len(x & y) / len(x | y), abs=0.05)


def compared(rows, got, lanes=phrases.LANES):
    maker = phrases.Fingerprints(lanes)
    want = Counter()
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
        a, b = a or "", b or ""
        e = edit(a, b)
        own, edited, after = (mark(t, maker) for t in (a, e, b))
        sha = hashlib.sha256(e.encode()).hexdigest()
        near = phrases.alike(own, edited), phrases.alike(own, after)
        want[i, len(a), sha, own.hex(), edited.hex(), *near] += 1
    assert Counter(tuple(r) for r in got) == want


def test_every_document(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id DESC").fetchall()
    compared(rows, phrases.op12(documents(spark, SF)).collect())


@pytest.mark.parametrize("n", [1, 2, 9])
def test_odd_rows(spark, n):
    texts = [None, "", "ab", "abc", "long text " * 30_000, "\U0001f600" * 10, "same", "same", " "]
    rows = [(i, t, "x") for i, t in enumerate(texts[:n])]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(3)
    compared([r[:2] for r in rows[::-1]], phrases.op12(df).collect())


def test_null_and_repeated_ids(spark):
    rows = [(None, "no id"), (None, "no id"), (3, "three"), (3, "three"), (3, "other three"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = phrases.op12(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert {r.fingerprint for r in got if r.n_chars == 5} == {
        phrases.Fingerprints().read(t).fingerprint.hex() for t in ("no id", "three")
    }
    assert phrases.op12(df.limit(0)).count() == 0


def test_columns(spark):
    texts = [None, "", "some text to parse", "some text to parse", "some text to pause"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "id long, text string, Fingerprint int")
    got = phrases.with_fingerprints(df, lanes=32)
    assert got.columns == ["id", "text", "fingerprint"]
    marks = [r.fingerprint for r in got.orderBy("id").collect()]
    assert marks[0] == marks[1] == "" and marks[2] == marks[3] != marks[4] and len(marks[2]) == 128
    a, b = (got.select(F.col("id").alias(n), F.col("fingerprint").alias(f"f{n}")) for n in "ab")
    near = a.join(b, F.col("a") <= F.col("b")).select("a", "b", phrases.likeness(F.col("fa"), F.col("fb")).alias("near"))
    for r in near.collect():
        assert r.near == phrases.alike(*(bytes.fromhex(marks[i]) for i in (r.a, r.b)))
    assert phrases.with_fingerprints(df.limit(0)).count() == 0

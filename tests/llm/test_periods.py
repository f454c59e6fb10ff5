"""Grammar, extensions and runs against brute force; edge cases of op13."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.llm import periods
from labelweave.llm.recompression import extensions, grammar, mirrored

EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("seed", range(40))
def test_extensions(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(2, 200)), int(rng.integers(1, 5))
    s = rng.integers(0, k, n)
    if seed % 3 == 0:
        s = np.tile(s[: max(1, n // 7)], 8)[:n]
    s = np.concatenate([[k], s, [k + 1]])
    levels, size = grammar(s), len(s)
    x, y = rng.integers(1, size - 1, (2, 200))
    x, y = x[x != y], y[x != y]
    right = extensions(levels, x, y)
    left = extensions(mirrored(levels), size - x, size - y)
    for a, b, r, q in zip(x, y, right, left, strict=True):
        ahead = next(e for e in range(size) if s[a + e] != s[b + e])
        behind = next(e for e in range(size) if s[a - 1 - e] != s[b - 1 - e])
        assert (r, q) == (ahead, behind)


def test_grammar_spells_the_sequence():
    s = np.random.default_rng(1).integers(0, 3, 500)
    levels = grammar(s)
    names = {i: [i] for i in range(3)}
    for level, after in zip(levels, levels[1:], strict=False):
        for a, b, name in zip(level.start, level.end, after.symbols, strict=True):
            spelt = [x for c in level.symbols[a:b] for x in names[int(c)]]
            assert names.setdefault(int(name), spelt) == spelt
    assert [x for c in levels[-1].symbols for x in names[int(c)]] == s.tolist()


def brute(words, least=24, repeats=3):
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, repeats * q):
                found.setdefault((start, length), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("seed", range(25))
def test_runs(seed, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(periods, "CANDIDATES", 50)
    rng, texts = random.Random(seed), []
    for _ in range(rng.randint(1, 6)):
        kinds = rng.randint(1, 6)
        words = [bytes([97 + rng.randrange(kinds)]) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            if words:
                a, p = rng.randrange(len(words)), rng.randint(1, 12)
                words[a:a] = words[a : a + p] * rng.randint(2, 20)
        texts.append(words)
    for least, repeats in ((24, 3), (6, 2)):
        got = [[tuple(r) for r in x.tolist()] for x in periods.runs_in(texts, least, repeats)]
        assert got == [brute(w, least, repeats) for w in texts]


def test_with_runs(spark):
    lines = ["buy now cheap pills"] * 9
    texts = [
        None, "", " \n ", "one", " ".join(lines), "before it " + " ".join(lines) + " after it", "a " * 40_000,
        "no break " * 30, "xy " * 24, "xy " * 23,
    ]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(4, texts[4], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, RUNS int").withColumn("row", F.lit(2))
    got = periods.with_runs(df)
    assert got.columns == ["doc_id", "text", "row", "runs", "collapsed"]
    by = {r.doc_id: r for r in got.collect()}
    assert Counter(r.doc_id for r in got.collect())[4] == 2
    assert [tuple(r) for r in by[5].runs] == [(2, 36, 4)]
    assert by[5].collapsed == "before it buy now cheap pills after it"
    assert [tuple(r) for r in by[6].runs] == [(0, 40_000, 1)] and by[6].collapsed == "a"
    assert [tuple(r) for r in by[7].runs] == [(0, 30, 1)]
    assert by[8].collapsed == "xy" and by[9].runs == [] and by[0].collapsed == by[2].collapsed == ""
    assert periods.with_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.with_runs(df, repeats=1)


def test_digests(spark):
    rows = [(0, None), (1, ""), (None, "a b c " * 20), (None, None), (7, "x y " * 500), (7, "x y " * 500)]
    got = periods.op13(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and got[4] == got[5]
    assert got[0].n_runs == 0 and got[0].start is None and got[0].runs_sha256 == got[0].collapsed_sha256 == EMPTY
    assert (got[2].n_runs, got[2].start, got[2].length, got[2].period, got[2].exponent_milli) == (1, 0, 60, 3, 20_000)
    assert got[2].runs_sha256 == hashlib.sha256(b"0,60,3\n").hexdigest()
    assert got[2].collapsed_sha256 == hashlib.sha256(b"a b c").hexdigest()


def test_nothing_is_shuffled(spark):
    from labelweave.llm.frames import documents

    plan = periods.op13(documents(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

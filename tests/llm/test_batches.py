"""Functions inside tasks give out few rows at a time, whatever the size of a batch."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from labelweave.llm import decontamination, minhash, toxicity
from labelweave.llm.words import U, Hasher


@pytest.fixture
def taken(monkeypatch):
    """Frames that ``mapInArrow`` is called on, with the functions it gets."""
    calls = []
    real = DataFrame.mapInArrow

    def spy(frame, run, schema, *args, **kwargs):
        calls.append((frame, run))
        return real(frame, run, schema, *args, **kwargs)

    monkeypatch.setattr(DataFrame, "mapInArrow", spy)
    return calls


def texts(n, words):
    rng = np.random.default_rng(3)
    out = [" ".join(f"w{x}" for x in rng.integers(0, 5000, words)) for _ in range(n)]
    return [None, "", *out, None, ""]


def test_hashes_are_given_out_in_parts(spark, taken):
    some = texts(400, 2000)
    ids = [None if i % 7 == 0 else i for i in range(len(some))]
    rows = [pa.array(range(len(some))), pa.array([5] * len(some)), pa.array(ids, pa.int64()), pa.array(some)]
    batch = pa.RecordBatch.from_arrays(rows, names=["rid_a", "rid_b", "doc_id", "text"])
    decontamination.hashed(spark.createDataFrame([], "rid_a long, rid_b long, doc_id long, text string"))
    (_, run), hasher = taken[0], Hasher()
    given = list(run(iter([batch, batch.slice(0, 0), batch.slice(3, 2)])))
    assert max(b.column("n").to_numpy().sum() for b in given) <= decontamination.GIVEN + 2000
    got = [r for b in given for r in b.to_pylist()]
    assert [(r["rid_a"], r["doc_id"]) for r in got] == [*enumerate(ids), (3, ids[3]), (4, ids[4])]
    for row, text in zip(got, [*some, *some[3:5]], strict=True):
        words = np.frombuffer(row["words"], U)
        assert len(words) == row["n"] and (words == decontamination._words(hasher, text)).all()


def test_scored_texts_travel_once(spark, taken):
    some = texts(1000, 1000)
    net = toxicity.Network.fresh()
    model = toxicity.Model(net, np.array([1.0, 0.1, 0.1, 0.0]), 0.1)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string").coalesce(1)
    got = toxicity.score(df, model)
    frame, run = taken[0]
    assert frame.columns == ["doc_id", "text"] and got.columns == ["doc_id", "text", "score"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some)], names=["doc_id", "text"])
    given = list(run(iter([batch, batch.slice(0, 0)])))
    assert len(given) > 1 and max(b.nbytes for b in given) < batch.nbytes / 2
    assert pa.Table.from_batches(given).select(["doc_id", "text"]).equals(pa.Table.from_batches([batch]))
    alone = [model.scores([toxicity.fold(t)])[0] for t in some[:40]]
    assert np.allclose(pa.Table.from_batches(given)["score"].to_numpy()[:40], alone, atol=1e-5)
    assert got.count() == len(some)


def test_scores_may_replace_the_text(spark, taken):
    model = toxicity.Model(None, np.zeros(4), 0.25)
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert sorted(toxicity.score(df, model, name="text").collect()) == [(1, 0.25), (2, 0.25)]
    # A frame may name the column in other case.
    assert sorted(toxicity.score(df, model, "TEXT").collect(), key=str) == [(1, "a", 0.25), (2, None, 0.25)]


def test_groups_cross_parts_of_batches(monkeypatch):
    monkeypatch.setattr(minhash, "AT_ONCE", 2)
    keys = [1, 1, 1, 2, 3, 3, 3, 3, 3]
    rows = [{"bucket": k, "i": 0, "j": k % 2, "node": n} for n, k in enumerate(keys)]
    batch = pa.RecordBatch.from_pylist(rows)
    groups = list(minhash._groups(iter([batch.slice(0, 5), batch.slice(5, 0), batch.slice(5)])))
    assert groups == [rows[:3], rows[3:4], rows[4:]]

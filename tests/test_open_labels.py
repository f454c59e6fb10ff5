"""Labels that are not known beforehand: none is lost, whatever their number."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from labelweave.operators import (
    frequent_labels,
    label_summary,
    merge_summaries,
    open_vote_counts,
    pivot_open,
    summarised_labels,
)
from labelweave.plans import get_corpus
from labelweave.plans.votes import HURRICANES24_OPEN_SCHEMA, HURRICANES24_LABELS


def rows():
    """A hot group and a hot label, nulls, and a tail of many labels."""
    out = [("hot", "joy", i) for i in range(300)] + [("hot", f"tail {i}", i) for i in range(200)]
    out += [("a", "joy", 1), ("a", None, 5), ("a", "fear", None), ("b", None, None), (None, "fear", 3)]
    return out + [("c", "rage", 2), ("c", "rage", 7), ("c", "", 4)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), "g string, label string, v int").repartition(5)


CELLS = {
    "count": lambda xs: len(xs),
    "flag": lambda xs: True,
    "sum": lambda xs: sum(x for x in xs if x is not None) if any(x is not None for x in xs) else None,
    "max": lambda xs: max((x for x in xs if x is not None), default=None),
    "mean": lambda xs: (lambda k: sum(k) / len(k) if k else None)([x for x in xs if x is not None]),
}


@pytest.mark.parametrize("kind", CELLS)
@pytest.mark.parametrize("most", [0, 2, 1000])
def test_no_label_is_lost(df, kind, most):
    value = "v" if kind in ("sum", "max", "mean") else None
    given = df if value else df.drop("v")
    got = pivot_open(given, "label", kind, value, most=most).collect()
    cells = defaultdict(list)
    for g, label, v in rows():
        cells[g, label].append(v)
    names = [c for c in got[0].__fields__ if c not in ("g", "other")]
    counts = Counter(label for _, label, _ in rows() if label is not None)
    assert names == sorted(sorted(counts, key=lambda n: (-counts[n], n))[:most])
    assert Counter(r.g for r in got) == Counter({g for g, _ in cells})
    empty = {"count": 0, "flag": False}.get(kind)
    for r in got:
        want = {label: CELLS[kind](xs) for (g, label), xs in cells.items() if g == r.g and label is not None}
        assert {n: r[n] for n in names} == {n: want.pop(n, empty) for n in names}
        assert r.other == pytest.approx(want)


def test_declared_labels_and_clashes(df):
    got = {r.g: r for r in pivot_open(df.drop("v"), "label", labels=["fear", "unheard"]).collect()}
    assert (got["a"].fear, got["a"].unheard, got["a"].other) == (1, 0, {"joy": 1})
    assert got["b"].other == {}
    with pytest.raises(ValueError, match="share names"):
        pivot_open(df.drop("v"), "label", labels=["g"])
    with pytest.raises(ValueError, match="needs a value"):
        pivot_open(df, "label", "sum")
    assert pivot_open(df.limit(0).drop("v"), "label").count() == 0


def test_groups_are_combined_before_the_shuffle(df):
    plan = pivot_open(df.drop("v"), "label", labels=["joy"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1 and "Window" not in plan and "Python" not in plan


def test_summaries_merge(df):
    parts = label_summary(df.withColumn("half", F.col("v") % 2), "label", by=["half"])
    assert parts.count() == 3
    merged = {r.label: r.n_rows for r in summarised_labels(merge_summaries(parts)).collect()}
    assert merged == dict(Counter(label for _, label, _ in rows() if label is not None))
    assert frequent_labels(df, "label", most=2) == ["fear", "joy"] or frequent_labels(df, "label", most=1) == ["joy"]
    assert frequent_labels(df.limit(0), "label") == []


def test_heavy_labels_of_many_are_found(spark):
    """Far more labels than are tracked: the frequent ones are there."""
    label = F.when(F.col("id") % 4 == 0, "often").when(F.col("id") % 7 == 0, "second")
    many = spark.range(0, 60_000, 1, 8).select(label.otherwise(F.col("id").cast("string")).alias("label"))
    assert frequent_labels(many, "label", most=2, tracked=128) == ["often", "second"]
    wide = pivot_open(many.withColumn("g", F.lit(1)), "label", most=2).first()
    assert (wide.often, wide.second) == (15_000, 6_429)
    assert sum(wide.other.values()) == 60_000 - 15_000 - 6_429 and set(wide.other.values()) == {1}


def test_open_votes(spark):
    votes = [
        ("x", {"w1": {"joy": True, "new": True}, "w2": {"joy": False, "new": None, "odd": False}, "w3": None}),
        ("y", None),
        ("z", {}),
    ]
    frame = spark.createDataFrame(votes, "text string, annotations map<string, map<string, boolean>>")
    got = {r.text: r for r in open_vote_counts(frame, "annotations", ["joy", "fear"], ["text"]).collect()}
    assert (got["x"].joy, got["x"].fear, got["x"].other) == (1, None, {"new": 1, "odd": 0})
    assert got["y"].joy is None and got["y"].other == got["z"].other == {}
    raw = spark.createDataFrame(
        [("Irma", '{"w1": {"awe": true, "joy": true}}')], "hurricane string, raw string"
    ).select("hurricane", F.lit("t").alias("text"), F.from_json(
        F.concat(F.lit('{"text": "t", "annotations": '), "raw", F.lit("}")), HURRICANES24_OPEN_SCHEMA
    )["annotations"].alias("annotations"))
    wide = get_corpus("Hurricanes24").build({"tweets": raw}).first()
    assert wide.joy == 1 and wide.other == {"awe": 1} and len(HURRICANES24_LABELS) == 24

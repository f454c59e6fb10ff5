"""Hot keys, copies and empty groups: results stay whole."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from labelweave.operators import (
    full_outer_merge,
    gather_lists,
    join_on,
    merge_by_key,
    natural_self_map,
    ordered,
    pivot_count,
    pivot_sum,
    positional_join,
    unknown_labels,
    unpivot,
    with_row_position,
)
from labelweave.plans import get_corpus

KEYS, LISTS, ORDER = ["k"], {"ids": "i", "marks": "m"}, ["i"]


def rows_of(n_hot, n_copies):
    rows = [("hot", i, None if i % 3 else float(i)) for i in range(n_hot)]
    rows += [("copies", i if n_copies < 0 else 7, None) for i in range(abs(n_copies))]
    rows += [(None, i, 1.0) for i in range(2)] + [("one", 5, None)]
    return rows


@pytest.mark.parametrize("items", [3, 10, 1000])
@pytest.mark.parametrize("range_rows", [5, 1000])
@pytest.mark.parametrize("n_copies", [40, -40])
def test_gather_cuts_ranked_rows(spark, items, range_rows, n_copies):
    rows = rows_of(50, n_copies)
    df = spark.createDataFrame(rows, "k string, i int, m double").repartition(4)
    aggs = [F.count("m").alias("n_marks"), F.avg("i").alias("mean_i")]
    got = gather_lists(df, KEYS, LISTS, ORDER, aggs, items_per_part=items, range_rows=range_rows)

    want = defaultdict(list)
    for k, i, m in rows:
        want[k].append((i, m))
    seen = {}
    for r in got.collect():
        seen[r.k, r.part] = list(zip(r.ids, r.marks, strict=True))
        ids = [i for i, _ in want[r.k]]
        if r.part:
            assert (r.n_marks, r.mean_i) == (None, None)
        else:
            assert r.n_marks == sum(m is not None for _, m in want[r.k])
            assert r.mean_i == pytest.approx(sum(ids) / len(ids))
    expected = {}
    for k, pairs in want.items():
        pairs.sort(key=lambda p: (p[0], p[1] is not None, p[1] or 0.0))
        for part in range(-(-len(pairs) // items)):
            expected[k, part] = pairs[part * items : (part + 1) * items]
    assert seen == expected


def jobs_of(spark, action):
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    action()
    return len(tracker.getJobIdsForGroup(group))


def test_building_starts_no_job(spark):
    df = spark.createDataFrame(rows_of(50, 40), "k string, i int, m double")
    assert jobs_of(spark, lambda: gather_lists(df, KEYS, LISTS, ORDER)) == 0
    assert jobs_of(spark, df.count) > 0
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ratings = events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("text"),
        F.lit("joy").alias("emotion"),
        F.col("value").alias("intensity"),
    )
    assert jobs_of(spark, lambda: get_corpus("EmoInt").build({"ratings": ratings})) == 0


def test_pivot_counts_sum_to_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") % 3).alias("l"))
    df = df.withColumn("l", F.when(F.col("l") == 2, None).otherwise(F.col("l").cast("string")))
    wide = pivot_count(df, "l", ["0", "1"])
    assert wide.columns == ["g", "0", "1"]
    known = wide.select(F.sum(F.col("0") + F.col("1"))).first()[0]
    outside = unknown_labels(df, "l", ["0", "1"]).agg(F.sum("n_rows")).first()[0]
    assert (known, outside) == (667, 333)
    assert wide.count() == 7


def test_unpivot_then_pivot_gives_the_cells_back(spark):
    rows = [("a", 1, None), ("b", None, 5), ("c", 2, 3)]
    df = spark.createDataFrame(rows, "k string, x int, y int")
    long = unpivot(df, ["x", "y"], "n", "v")
    assert long.count() == 4
    back = pivot_sum(long, "n", ["x", "y"], "v").orderBy("k").collect()
    assert [tuple(r) for r in back] == rows


def test_merge_later_source_wins(spark):
    a = spark.createDataFrame([(1, "old", 1.0), (2, "only", None)], "id int, text string, v double")
    b = spark.createDataFrame([(1, 2.0), (3, 9.0)], "id int, v double")
    c = spark.createDataFrame([(1, "new")], "id int, text string")
    got = merge_by_key([a, b, c], "id", {"text": "string", "v": "double"}).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "new", 2.0), (2, "only", None), (3, None, 9.0)]


def test_full_outer_keys(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "id int, x int")
    b = spark.createDataFrame([(2, 200), (3, 300)], "id int, y int")
    both = {tuple(r) for r in full_outer_merge(a, b, ["id"]).collect()}
    assert both == {(1, 10, None), (2, 20, 200), (3, None, 300)}
    left = {tuple(r) for r in full_outer_merge(a, b, ["id"], coalesce_keys=False).collect()}
    assert left == {(1, 10, None), (2, 20, 200), (None, None, 300)}


def test_natural_self_join_drops_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, x string")
    upper = {"u": F.upper("x")}
    assert natural_self_map(df, "id", upper).count() == 2
    assert [tuple(r) for r in natural_self_map(df, "id", upper, as_join=True).collect()] == [
        (1, "a", "A")
    ]


def test_positional_join_pads_the_shorter_side(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"a{i}\n" for i in range(5)))
    (tmp_path / "b.txt").write_text("".join(f"b{i}\n" for i in range(3)))
    a = spark.read.text(str(tmp_path / "a.txt")).withColumnRenamed("value", "a")
    b = spark.read.text(str(tmp_path / "b.txt")).withColumnRenamed("value", "b")
    pairs = positional_join(a, b).orderBy("a").collect()
    assert [tuple(r) for r in pairs] == [
        ("a0", "b0"), ("a1", "b1"), ("a2", "b2"), ("a3", None), ("a4", None),
    ]


def test_row_position_over_many_files_and_splits(spark, tmp_path):
    # Files of very different size: Spark reads the largest first, positions
    # must still follow the file names.
    want = []
    for name, n in (("a", 3), ("b", 4000), ("c", 0), ("d", 700)):
        lines = [f"{name}{i}" for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("".join(x + "\n" for x in lines))
        want += lines
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        numbered = with_row_position(spark.read.text(str(tmp_path)), "n")
        got = [r.value for r in numbered.orderBy("n").collect()]
        assert got == want
        assert [r.n for r in numbered.orderBy("n").collect()] == list(range(len(want)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parquet_row_position_over_files(spark, tmp_path):
    for part, (low, high) in enumerate([(0, 5), (5, 300), (300, 301)]):
        spark.range(low, high, 1, 1).write.parquet(f"{tmp_path}/p{part}")
    scan = spark.read.parquet(*[f"{tmp_path}/p{i}" for i in range(3)])
    got = with_row_position(scan, "n", parquet=True).orderBy("n").collect()
    assert [tuple(r) for r in got] == [(i, i) for i in range(301)]


def test_order_spreads_a_hot_key_and_copies(spark):
    # Two thirds of the rows share one key, half of those are copies.
    hot = F.when(F.col("id") % 3 < 2, 500).otherwise(F.col("id"))
    same = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(0, 60_000, 1, 16).select(hot.alias("k"), same.alias("v"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        done = ordered(df, ["k"])
        sizes = done.groupBy(F.spark_partition_id()).count().collect()
        keys = [r.k for r in done.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert done.columns == ["k", "v"]
    assert keys == sorted(keys) and len(keys) == 60_000
    assert max(r["count"] for r in sizes) < 20_000


def test_join_splits_a_hot_key(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
        texts = spark.range(0, 90_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
        meta = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("m"))
        joined = join_on(texts, meta, ["k"])
        assert len(joined.collect()) == 90_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

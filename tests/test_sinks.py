"""Writing, manifest, samples, and batch runs."""

import pytest
from pyspark.sql import functions as F

from labelweave.runner import build, run_many, run_one
from labelweave.sinks import (
    TargetNotEmpty,
    file_stats,
    merge_manifest,
    read_dataset,
    sample_one,
    sample_stored,
    write_dataset,
)
from labelweave.sinks.dataset import read_info, size_in_bytes

TWEETS = 'tweet_id,sentiment,author,content\n1,love,a,one\n2,worry,b,two\n'


def test_guard(spark, tmp_path):
    folder = f"{tmp_path}/d"
    (tmp_path / "d").mkdir()
    write_dataset(spark.range(5), folder)
    with pytest.raises(TargetNotEmpty):
        write_dataset(spark.range(7), folder)
    assert read_dataset(spark, folder).count() == 5
    write_dataset(spark.range(7), folder, overwrite=True)
    assert read_dataset(spark, folder).count() == 7


def test_shards(spark, tmp_path):
    big = spark.range(0, 200_000, 1, 2).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    write_dataset(big, f"{tmp_path}/n", num_shards=5)
    assert len(list((tmp_path / "n").glob("*.parquet"))) == 5
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    write_dataset(big, f"{tmp_path}/s", max_shard_size="2MB")
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    assert len(list((tmp_path / "s").glob("*.parquet"))) > 4
    for folder in ("n", "s"):
        assert read_dataset(spark, f"{tmp_path}/{folder}").count() == 200_000
    assert size_in_bytes("500MB") == 500_000_000 and size_in_bytes(7) == 7
    with pytest.raises(ValueError):
        size_in_bytes("lots")


def test_info_lies_beside_the_data(spark, tmp_path):
    write_dataset(spark.range(3), f"{tmp_path}/d", info={"dataset": "d", "labels": ["a", "b"]})
    assert read_dataset(spark, f"{tmp_path}/d").columns == ["id"]
    info = read_info(spark, f"{tmp_path}/d").first()
    assert (info.dataset, info.labels) == ("d", ["a", "b"])


def test_manifest_merge(spark):
    old = spark.createDataFrame([("b", "x"), ("b", "y"), ("a", "z")], "dataset string, name string")
    new = spark.createDataFrame([("b", "w")], "dataset string, name string")
    assert [tuple(r) for r in merge_manifest(old, new).collect()] == [("a", "z"), ("b", "w")]


def test_file_stats_lists_without_reading(spark, tmp_path):
    write_dataset(spark.range(3), f"{tmp_path}/d", num_shards=1)
    stats = file_stats(spark, f"{tmp_path}/d", str(tmp_path))
    assert "content" not in stats._jdf.queryExecution().executedPlan().toString()
    row = stats.first()
    file = next((tmp_path / "d").glob("*.parquet"))
    assert (row.name, row.file_path, row.file_size) == (file.name, f"d/{file.name}", file.stat().st_size)


def test_sample_is_seeded(spark):
    df = spark.range(0, 1000, 1, 4).withColumn("t", F.col("id").cast("string"))
    one = sample_one(df, ["id"], seed=1).collect()
    assert len(one) == 1
    assert one == sample_one(df.repartition(7), ["id"], seed=1).collect()
    assert len({sample_one(df, ["id"], seed=s).first().id for s in range(10)}) > 5


def test_ordered_files(spark, tmp_path):
    df = spark.range(0, 50_000, 1, 6).select((F.hash("id") % 1000).alias("k"), "id")
    for name, options in (("a", {"num_shards": 3}), ("b", {}), ("c", {"max_shard_size": None})):
        write_dataset(df, f"{tmp_path}/{name}", order_by=["k", "id"], **options)
        files = sorted((tmp_path / name).glob("part-*.parquet"))
        rows = [r for f in files for r in spark.read.parquet(str(f)).collect()]
        assert rows == sorted(rows) and len(rows) == 50_000
        assert name != "a" or len(files) == 3


def test_stored_sample(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).withColumn("t", F.col("id").cast("string"))
    write_dataset(df, f"{tmp_path}/d", max_shard_size=None)
    picks = [sample_stored(spark, f"{tmp_path}/d", seed=s).collect() for s in range(8)]
    assert all(len(p) == 1 and str(p[0].id) == p[0].t for p in picks)
    assert len({p[0].id for p in picks}) > 4
    assert picks[0] == sample_stored(spark, f"{tmp_path}/d", seed=0).collect()
    write_dataset(df.limit(0), f"{tmp_path}/e")
    assert sample_stored(spark, f"{tmp_path}/e").count() == 0


def test_run_one_writes_everything(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "data.csv").write_text(TWEETS)
    out = f"{tmp_path}/out"
    assert run_one(spark, "crowdflower", f"{tmp_path}/in", out) == 2
    with pytest.raises(TargetNotEmpty):
        run_one(spark, "CrowdFlower", f"{tmp_path}/in", out)
    assert run_one(spark, "CrowdFlower", f"{tmp_path}/in", out, overwrite=True, num_shards=1) == 2

    manifest = spark.read.parquet(f"{out}/manifest")
    on_disk = {p.name for p in (tmp_path / "out" / "CrowdFlower").glob("*.parquet")}
    listed = {r.name for r in manifest.filter("dataset = 'CrowdFlower'").collect()}
    assert listed == on_disk
    samples = spark.read.parquet(f"{out}/samples").collect()
    assert len(samples) == 1 and '"tweet_id"' in samples[0].sample
    assert read_info(spark, f"{out}/CrowdFlower").first().dataset == "CrowdFlower"
    with pytest.raises(KeyError, match="choose one of"):
        run_one(spark, "nothing", f"{tmp_path}/in", out)


def test_run_many(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "data.csv").write_text(TWEETS)
    sources = {"CrowdFlower": f"{tmp_path}/in", "XED": f"{tmp_path}/none", "TEC": f"{tmp_path}/in"}
    report = run_many(spark, sources, f"{tmp_path}/out", skip=["tec"]).collect()
    assert [(r.dataset, r.status, r.n_rows) for r in report] == [
        ("CrowdFlower", "done", 2), ("XED", "failed", None), ("TEC", "skipped", None),
    ]
    assert report[1].error
    with pytest.raises(RuntimeError, match="XED"):
        run_many(spark, {"XED": sources["XED"]}, f"{tmp_path}/out2", skip_errors=False)
    with pytest.raises(KeyError):
        run_many(spark, {"nope": ""}, f"{tmp_path}/out3")
    assert not (tmp_path / "out3").exists()


def test_build_takes_frames(spark):
    raws = {"tweets": spark.createDataFrame([("1", "love", "a", "x")], ["tweet_id", "sentiment", "author", "content"])}
    assert build(spark, "CrowdFlower", raws).first().love == 1

"""Manifest, samples, profile and row counts of written datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import col, cols


def file_stats(spark: SparkSession, folder: str, base: str | None = None) -> DataFrame:
    """Name, relative path, size and time of every file below a folder.

    A listing only: Spark does not open the files, as their content is not asked
    for, and there is one row per file however many records it holds.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    below = (base or folder).rstrip("/") + "/"
    after = F.substr("path", F.locate(below, F.col("path")) + len(below))
    return files.select(
        F.substring_index("path", "/", -1).alias("name"),
        after.alias("file_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("creation_time"),
    )


def merge_manifest(old: DataFrame, new: DataFrame, key: str = "dataset") -> DataFrame:
    """Replace the entries of each dataset that occurs in ``new``, in order."""
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new).orderBy(key, *[c for c in new.columns if c != key])


def _store(df: DataFrame, folder: str) -> None:
    # Only the partitions present in ``df`` are replaced, so a rerun of one
    # dataset never reads or rewrites the entries of the others.
    (
        df.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset")
        .parquet(folder)
    )


def store_manifest(spark: SparkSession, data_dir: str, dataset: str) -> None:
    """Upsert the file list of one dataset into ``data_dir/manifest``."""
    stats = file_stats(spark, f"{data_dir}/{dataset}", data_dir)
    _store(stats.withColumn("dataset", F.lit(dataset)), f"{data_dir}/manifest")


def sample_one(
    df: DataFrame, key: Sequence[str] | None = None, seed: int = 0, draw: Column | None = None
) -> DataFrame:
    """One random row, the same one for the same seed.

    Each task keeps its own best row, so nothing is sorted or shuffled whole.
    ``key`` identifies a row; without it the whole row does. ``draw`` is the
    random order, by default a hash of seed and key.
    """
    names = list(key) if key else df.columns
    if draw is None:
        draw = F.xxhash64(F.lit(seed), *cols(names))
    return df.orderBy(draw, *cols(names)).limit(1)


def sample_stored(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """One random row of a Parquet dataset, drawn by its place in the files.

    The draw reads no data column, the row itself comes from one file.
    """
    stored = spark.read.parquet(folder)
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    drawn = (
        stored.select(part.alias("part"), place[0].alias("path"), place[1].alias("row"))
        .orderBy(F.xxhash64(F.lit(seed), "part", "row"), "path", "row")
        .limit(1)
        .collect()
    )
    if not drawn:
        return stored.limit(0)
    return stored.filter((place[0] == drawn[0]["path"]) & (place[1] == drawn[0]["row"]))


def store_sample(spark: SparkSession, data_dir: str, dataset: str, seed: int = 0) -> None:
    """Upsert one sample row, as JSON, into ``data_dir/samples``."""
    row = sample_stored(spark, f"{data_dir}/{dataset}", seed)
    packed = row.select(
        F.to_json(F.struct(*cols(sorted(row.columns)))).alias("sample"),
        F.lit(dataset).alias("dataset"),
    )
    _store(packed, f"{data_dir}/samples")


def dataset_profile(df: DataFrame, group: Sequence[str], label: str) -> DataFrame:
    """Rows and distinct labels per group, and whether it has several labels."""
    return (
        df.groupBy(*cols(group))
        .agg(F.count(F.lit(1)).alias("size"), F.countDistinct(col(label)).alias("labels"))
        .withColumn("multilabel", F.col("labels") > 1)
    )


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named frame."""

    def count(name: str, df: DataFrame) -> DataFrame:
        rows: Column = F.count(F.lit(1))
        return df.agg(rows.alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")

    return reduce(DataFrame.union, [count(n, d) for n, d in frames.items()])

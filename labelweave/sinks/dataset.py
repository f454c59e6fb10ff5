"""Parquet datasets: guarded, sharded, documented."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..columns import cols
from ..operators.rows import TIES, ordered, with_ties

# Fixed value: default upper size of one output file.
MAX_SHARD_SIZE = "500MB"
# Spark skips folders that start with an underscore when it reads a dataset.
INFO_FOLDER = "_info"

_UNITS = {"": 1, "B": 1, "KB": 10**3, "MB": 10**6, "GB": 10**9, "KIB": 2**10, "MIB": 2**20, "GIB": 2**30}
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


class TargetNotEmpty(Exception):
    """The target folder already holds data and may not be overwritten."""


def size_in_bytes(size: int | str) -> int:
    if isinstance(size, int):
        return size
    match = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]*)\s*", size)
    if not match or match.group(2).upper() not in _UNITS:
        raise ValueError(f"cannot read size {size!r}")
    return int(match.group(1)) * _UNITS[match.group(2).upper()]


def holds_data(spark: SparkSession, folder: str) -> bool:
    """Whether the folder exists and is not empty, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path) and len(fs.listStatus(path)) > 0


@contextmanager
def _shard_size(spark: SparkSession, size: int | str | None):
    """Have Spark aim at partitions of this size for the time of one write."""
    before = spark.conf.get(_ADVISORY)
    if size is not None:
        spark.conf.set(_ADVISORY, str(size_in_bytes(size)))
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, before)


def write_dataset(
    df: DataFrame,
    folder: str,
    overwrite: bool = False,
    num_shards: int | None = None,
    max_shard_size: int | str | None = MAX_SHARD_SIZE,
    info: Mapping[str, object] | None = None,
    storage_options: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
) -> None:
    """Write a frame as Parquet.

    ``num_shards`` fixes the number of files. Otherwise Spark rebalances the
    rows at run time so that no file is much over ``max_shard_size``; None
    skips that shuffle and writes one file per partition. With ``order_by`` the
    files hold the rows in that order, file after file. ``info`` is stored next
    to the data, ``storage_options`` go to the writer.
    """
    spark = df.sparkSession
    if holds_data(spark, folder) and not overwrite:
        raise TargetNotEmpty(f"{folder} is not empty; pass overwrite=True or choose another folder")

    def save(frame: DataFrame) -> None:
        # The guard above has settled what may be replaced.
        frame.write.mode("overwrite").options(**(storage_options or {})).parquet(folder)

    if order_by:
        # A sort ranges the rows over partitions by itself; only their size is set.
        sized = max_shard_size if num_shards is None else None
        with _shard_size(spark, sized):
            if num_shards is None:
                save(ordered(df, order_by))
            else:
                keys = [*cols(order_by), *TIES]
                ranged = with_ties(df).repartitionByRange(num_shards, *keys)
                save(ranged.sortWithinPartitions(*keys).drop(*TIES))
    elif num_shards is not None:
        save(df.repartition(num_shards))
    elif max_shard_size is not None:
        with _shard_size(spark, max_shard_size):
            save(df.hint("rebalance"))
    else:
        save(df)
    if info:
        row = spark.createDataFrame([tuple(info.values())], list(info.keys()))
        row.coalesce(1).write.mode("overwrite").json(f"{folder}/{INFO_FOLDER}")


def read_dataset(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(folder)
    return df.select(*columns) if columns else df


def read_info(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.json(f"{folder}/{INFO_FOLDER}")

"""Jump consistent hashing: stable keys to shards without a ring table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..columns import cols
from .frames import frozen

# Multiplier of the published generator (fixed value).
LCG = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. ``jump(k, n + 1)`` differs from ``jump(k, n)`` only
    where it is ``n``: an appended shard takes rows, the others exchange none."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        shard[going] = ahead[going]
        state[going] = state[going] * LCG + np.uint64(1)
        draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[going] = np.floor((shard[going] + 1) * (2.0**31 / draw)).astype(np.int64)
        going = going[ahead[going] < shards]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Column form of :func:`jump` for a long column without nulls."""

    @F.pandas_udf(T.IntegerType())
    def place(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in keys:
            yield pd.Series(jump(part.to_numpy().view(np.uint64), shards))

    return place(key)


def with_shards(df: DataFrame, keys: Sequence[str], shards: int, grown: int | None = None) -> DataFrame:
    """Add ``shard``, and ``grown_shard`` for another number of shards.

    Keys, nulls included, are hashed to 64 bits first. Equal keys share a shard;
    rows that repeat are kept; texts of any length are carried as they are. Columns that
    are named ``shard`` or, with ``grown``, ``grown_shard`` already, in any case, are
    replaced; all others stay. Narrow: no shuffle. Empty frames stay empty.
    """
    key = F.xxhash64(*cols(keys))
    out = df.withColumn("shard", shard_of(key, shards))
    return out.withColumn("grown_shard", shard_of(key, grown)) if grown else out


def with_slots(df: DataFrame, rows_per_task: int = 500_000, most_pieces: int = 100_000) -> DataFrame:
    """Number the rows of each shard from 0, without gaps: ``slot``, which replaces a
    column of that name; other columns keep theirs, as rows travel whole.

    A shard may hold any number of rows, so it is cut into pieces: rows are numbered
    within a piece, and pieces start where the ones before end. ``df`` is frozen, so
    counts and numbers see the same rows; pass narrow rows. There are at most
    ``most_pieces`` piece counts, which bounds what is broadcast.
    """
    whole = F.struct(*cols([c for c in df.columns if c != "slot"])).alias("row")
    rows = frozen(
        df.select(whole, "shard", F.monotonically_increasing_id().alias("piece_seed")), "slots"
    )
    shards = rows.select("shard").distinct().count()
    pieces = max(1, min(rows.count() // rows_per_task + 1, most_pieces // max(1, shards)))
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("piece_seed"), F.lit(pieces)))
    sizes = rows.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("piece_rows"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("shard").alias("s"),
        F.col("piece").alias("p"),
        F.coalesce(F.sum("piece_rows").over(before), F.lit(0)).alias("start"),
    )
    within = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("piece_seed"))
    return (
        rows.withColumn("within", within)
        .join(F.broadcast(starts), (F.col("shard") == F.col("s")) & (F.col("piece") == F.col("p")))
        .select("row.*", (F.col("start") + F.col("within") - 1).alias("slot"))
    )


def write_shards(df: DataFrame, folder: str) -> None:
    """Write one folder per shard; ``df`` has a ``shard`` column."""
    df.write.partitionBy("shard").parquet(folder)


def op10(df: DataFrame, shards: int = 8) -> DataFrame:
    """Every document's shard under the ``key`` law, and the one with a shard more."""
    facts = df.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = with_slots(with_shards(facts, ["doc_id"], shards, grown=shards + 1))
    return placed.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )

"""From raw documents to shards: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes what its predecessor kept, as a Parquet table, and returns the columns
of ``documents``; the last adds ``shard``. Null and empty texts pass toxicity (they are
scored like any text), are never duplicates or leaks, and have no words to mix; rows
that repeat become one in the second stage; empty tables pass through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelweave.llm import decontamination, minhash, mixing, sharding, toxicity
from labelweave.llm.frames import documents, frozen, table

SHARDS = 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network trained on ``labels`` accepts. Null and empty texts are
    scored as one empty window, very long ones in all of their windows; equal texts have
    equal scores; without usable labels every document has the same score."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word runs agree to four fifths or more: the
    one with the smallest id, of equal ids the first by file and place. Documents without
    words all stay; whole texts are compared."""
    return minhash.keep_one(docs, size=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark`` and no paraphrase of one. Documents
    without words hold none; an empty benchmark removes nothing; texts are searched whole."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target weights. Null
    sources are one source; documents without words come in certain copies only; ties of
    the ranking go by id."""
    return mixing.mix(docs)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard that their id hashes to, null ids together. A column
    ``shard`` is replaced; all stages keep other columns, whatever their names, and give
    an empty table for an empty one."""
    return sharding.with_shards(docs, ["doc_id"], SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", to_shards),
]

# A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

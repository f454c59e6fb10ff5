"""Frames that are read more than once: frozen copies and row identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import col, cols
from ..session import shared_folder

# Words are runs of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def frozen(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the session's shared folder and read it back.

    This cuts the lineage: lost executors cannot change rows that several readers
    must agree on, and no reader repeats the work.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def scanned(df: DataFrame) -> DataFrame:
    """``df`` itself if it is a file scan, filtered or projected; else a frozen copy.

    Operators that tell rows apart start with this, so that all they derive from a frame
    names its rows alike.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return df if plan.nodeName().startswith("LogicalRelation") else frozen(df, "rows")


def with_row_id(scan: DataFrame, **columns: str | Column) -> DataFrame:
    """Columns of a scan, by new names, and ``rid_a`` and ``rid_b``, which name a row.

    The id is the file and the row's place in it, the same in every evaluation. Keys such
    as ``doc_id`` may be null or repeated, so operators tell rows apart by this.
    """
    wanted = {n: col(c) if isinstance(c, str) else c for n, c in columns.items()}
    return scan.select(
        *[c.alias(n) for n, c in wanted.items()],
        F.xxhash64("_metadata.file_path").alias("rid_a"),
        F.col("_metadata.row_index").alias("rid_b"),
    )


def carried(scan: DataFrame) -> DataFrame:
    """Whole rows as one column ``row``, beside their id: no name can clash. Take them
    out with ``row.*``."""
    return with_row_id(scan, row=F.struct(*cols(scan.columns)))


def same_row() -> Column:
    """Join condition of ``rid_a``, ``rid_b`` with another side's ``_a``, ``_b``."""
    return (F.col("rid_a") == F.col("_a")) & (F.col("rid_b") == F.col("_b"))


def row_keys() -> list[Column]:
    return [F.col("rid_a").alias("_a"), F.col("rid_b").alias("_b")]


def hidden(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name

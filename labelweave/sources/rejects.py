"""Delimited scans that keep what they reject: one pass, two outcomes, counted.

Every row of the scan is either fine or carries the reason, the raw record and the file
it was rejected for. Kept and rejected rows are filters of one frame, or two folders of
one write; counts are observed while the rows stream by.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, cols
from ..functions.labels import parse_number
from .delimited import COMMA, Dialect, as_schema

REJECT = "_reject"
FIELDS = "number of fields"


def scan_with_rejects(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str,
    dialect: Dialect = COMMA,
) -> DataFrame:
    """All rows of the files: declared columns and ``_reject``.

    ``_reject`` is null where a row is fine; otherwise a struct of ``reason`` (the number
    of fields, or the first column whose value is not of its type), ``record`` (the row
    as it stands in the file; with wrong types, its fields written in the same dialect)
    and ``file``. Rejected rows keep what could be read.
    Results do not depend on the columns a query picks: nothing is pruned while parsing.
    """
    declared = as_schema(schema).fields
    names = {f.name for f in declared}
    bad = "_bad"
    while bad in names:
        bad = "_" + bad
    if REJECT in names:
        raise ValueError(f"a column is named {REJECT}")
    text = [T.StructField(f.name, T.StringType()) for f in declared]
    rows = (
        spark.read.schema(T.StructType([*text, T.StructField(bad, T.StringType())]))
        .options(**{**dialect.options(), "enforceSchema": "true", "mode": "PERMISSIVE"})
        .option("columnNameOfCorruptRecord", bad)
        .option("columnPruning", "false")
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    reason = F.when(col(bad).isNotNull(), F.lit(FIELDS))
    values = {}
    for f in declared:
        values[f.name] = col(f.name)
        if f.dataType != T.StringType():
            kind = f.dataType.simpleString()
            values[f.name] = parse_number(col(f.name), kind)
            wrong = col(f.name).isNotNull() & values[f.name].isNull()
            reason = reason.when(wrong, F.lit(f"{f.name} is no {kind}"))
    # A record of the right arity is not kept by the parser: it is put together again.
    record = F.coalesce(col(bad), F.to_csv(F.struct(*cols([f.name for f in declared])), _written(dialect)))
    told = F.struct(reason.alias("reason"), record.alias("record"), F.col("_metadata.file_path").alias("file"))
    return rows.select(
        *[v.alias(n) for n, v in values.items()], F.when(reason.isNotNull(), told).alias(REJECT)
    )


def _written(dialect: Dialect) -> dict[str, str]:
    options = {k: v for k, v in dialect.options().items() if k in ("sep", "quote", "escape", "nullValue")}
    return {"emptyValue": "", **options}


def kept_rows(scan: DataFrame) -> DataFrame:
    return scan.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected_rows(scan: DataFrame) -> DataFrame:
    """``reason``, ``record`` and ``file`` of every rejected row."""
    return scan.filter(F.col(REJECT).isNotNull()).select(f"{REJECT}.*")


def observed(scan: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The scan, and counts that are there once an action has run over it: ``n_rows``,
    ``n_rejected`` and ``n_wrong_fields``. No further scan counts them."""
    seen = Observation(name)
    reason = F.col(f"{REJECT}.reason")
    counts: list[Column] = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count(reason).alias("n_rejected"),
        F.count(F.when(reason == FIELDS, 1)).alias("n_wrong_fields"),
    ]
    return scan.observe(seen, *counts), seen


def read_observed(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str,
    dialect: Dialect = COMMA,
    bad_rows: str = "drop",
) -> tuple[DataFrame, Observation]:
    """Rows and counts: ``drop`` leaves rejected rows out, ``keep`` marks them in
    ``_reject``, ``raise`` fails with the first one's reason and record. The counts are
    the same in every mode."""
    if bad_rows not in ("drop", "keep", "raise"):
        raise ValueError(f"bad_rows is {bad_rows!r}, not drop, keep or raise")
    scan, seen = observed(scan_with_rejects(spark, paths, schema, dialect))
    if bad_rows == "keep":
        return scan, seen
    if bad_rows == "drop":
        return kept_rows(scan), seen
    said = F.concat(F.lit("rejected: "), F.col(f"{REJECT}.reason"), F.lit(": "), F.col(f"{REJECT}.record"))
    fine = F.when(F.col(REJECT).isNull(), True).otherwise(F.raise_error(said).cast("boolean"))
    return scan.filter(fine).drop(REJECT), seen


def write_split(scan: DataFrame, folder: str) -> dict[str, int]:
    """Write kept and rejected rows in one pass: ``rejected=false`` and ``rejected=true``
    below ``folder``. Returns the counts."""
    marked, seen = observed(scan)
    marked.withColumn("rejected", F.col(REJECT).isNotNull()).write.partitionBy("rejected").parquet(folder)
    return seen.get


def read_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejected rows) of :func:`write_split`."""
    both = spark.read.parquet(folder)
    kept = both.filter("rejected = 'false'").drop("rejected", REJECT)
    return kept, both.filter("rejected = 'true'").select(f"{REJECT}.*")

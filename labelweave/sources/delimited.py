"""Delimited-file scans with a declared schema and an explicit bad-row policy.

All scans are native Spark CSV scans; nothing is parsed in Python. Column names
come from a declared schema or from the header, never from type inference.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col
from ..functions.labels import parse_number
from .quoted import parsed_records, quoted_records

# What to do with a row that does not fit the schema.
BAD_ROW_MODES = {"raise": "FAILFAST", "null": "PERMISSIVE", "drop": "DROPMALFORMED"}


@dataclass(frozen=True)
class Dialect:
    """How a delimited file is written.

    ``multi_line`` lets a quoted field hold line breaks. It makes a file
    unsplittable, so switch it off for layouts whose fields never hold one:
    Spark then splits each file over many tasks. With ``split`` files are split
    all the same: two more light scans find out where blocks begin inside quotes
    (``quoted.py``). That pays for files of many blocks.
    """

    sep: str = ","
    quote: str = '"'
    escape: str = '"'
    header: bool = True
    null_token: str | None = None
    multi_line: bool = True
    line_sep: str | None = None
    split: bool = False

    def options(self) -> dict[str, str]:
        opts = {
            "sep": self.sep,
            "quote": self.quote,
            "escape": self.escape,
            "header": str(self.header).lower(),
            "multiLine": str(self.multi_line).lower(),
        }
        if self.header:
            # A declared schema is otherwise matched by position, silently
            # swapping columns of files whose headers are ordered differently.
            opts["enforceSchema"] = "false"
        if self.null_token is not None:
            opts["nullValue"] = self.null_token
        if self.line_sep is not None:
            opts["lineSep"] = self.line_sep
        return opts


COMMA = Dialect()
TAB = Dialect(sep="\t")


def _paths(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_delimited(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str,
    dialect: Dialect = COMMA,
    bad_rows: str = "raise",
) -> DataFrame:
    """Scan one file, a list of files, or globs, as one table.

    ``bad_rows`` says what becomes of a row with the wrong number of fields or
    a value that is not of its type: ``raise``, ``drop``, or ``null`` (keep the
    row, with nulls for what is wrong).
    """
    declared = as_schema(schema)
    if dialect.split and dialect.multi_line:
        records = quoted_records(
            spark, paths, dialect.sep, dialect.quote, dialect.escape, dialect.line_sep
        )
        return parsed_records(records, declared, dialect.options(), bad_rows)
    reader = spark.read.options(**dialect.options()).option("mode", BAD_ROW_MODES[bad_rows])
    if bad_rows != "drop":
        return reader.schema(declared).csv(_paths(paths))
    # Spark checks only the columns a query picks, so which rows survive would
    # depend on the query. Here the number of fields is checked by an unpruned
    # scan of strings, and the types by a filter over all typed columns.
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared.fields])
    rows = reader.schema(text).option("columnPruning", "false").csv(_paths(paths))
    typed = [f for f in declared.fields if f.dataType != T.StringType()]
    for f in typed:
        parsed = parse_number(col(f.name), f.dataType.simpleString())
        rows = rows.filter(col(f.name).isNull() | parsed.isNotNull())
    return rows.select(
        *[
            parse_number(col(f.name), f.dataType.simpleString()).alias(f.name)
            if f in typed
            else col(f.name)
            for f in declared.fields
        ]
    )


def count_malformed(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str,
    dialect: Dialect = COMMA,
) -> DataFrame:
    """Rows read, and rows a ``bad_rows="drop"`` scan leaves out, per file."""
    declared = as_schema(schema).fields
    text = [T.StructField(f.name, T.StringType()) for f in declared]
    scan = (
        spark.read.schema(T.StructType([*text, T.StructField("_bad", T.StringType())]))
        .options(**{**dialect.options(), "enforceSchema": "true", "mode": "PERMISSIVE"})
        .option("columnNameOfCorruptRecord", "_bad")
        .option("columnPruning", "false")
        .csv(_paths(paths))
    )
    bad = F.col("_bad").isNotNull()
    for f in declared:
        if f.dataType != T.StringType():
            parsed = parse_number(col(f.name), f.dataType.simpleString())
            bad = bad | (col(f.name).isNotNull() & parsed.isNull())
    # Spark wants a data column read beside the malformed one.
    first = col(declared[0].name)
    rows = F.count(first) + F.coalesce(F.sum(first.isNull().cast("long")), F.lit(0))
    return (
        scan.withColumn("file_name", F.col("_metadata.file_name"))
        .groupBy("file_name")
        .agg(rows.alias("n_rows"), F.count(F.when(bad, 1)).alias("n_malformed"))
    )


def read_header_cast(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str,
    dialect: Dialect = COMMA,
) -> DataFrame:
    """Read by header name, then cast the wanted columns to declared types.

    Files may hold more columns than ``schema`` names, in any order. The header
    costs one tiny job; the columns themselves stay strings until the cast.
    """
    raw = spark.read.options(**dialect.options()).csv(_paths(paths))
    return raw.select(
        *[col(f.name).cast(f.dataType).alias(f.name) for f in as_schema(schema).fields]
    )


def read_headerless(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str,
    dialect: Dialect = COMMA,
    bad_rows: str = "raise",
) -> DataFrame:
    """Name the columns of a file without a header by position."""
    plain = Dialect(**{**dialect.__dict__, "header": False})
    return read_delimited(spark, paths, schema, plain, bad_rows)


# Files whose first lines one job fetches; the plan has a scan per file.
HEADERS_PER_JOB = 100


def _literal(path: str) -> str:
    """A path that is taken as it is where globs are accepted."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _first_lines(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    # Spark reports paths percent-encoded, but takes them plain.
    files = [unquote(file) for file in spark.read.text(paths).inputFiles()]
    heads: list[tuple[str, str]] = []
    for at in range(0, len(files), HEADERS_PER_JOB):
        # Each scan ends at its limit, so no more than a file's first lines are read. The
        # limit may take a row of any split, and a multi-line file has but one.
        lines = spark.read.schema("value string").options(sep="\0", quote="", escape="", multiLine="true")
        scans = [
            lines.csv(_literal(file)).limit(1).select(F.lit(file).alias("path"), "value")
            for file in files[at : at + HEADERS_PER_JOB]
        ]
        heads += [(r["path"], r["value"]) for r in reduce(DataFrame.union, scans).collect()]
    return heads


def _files_by_header(
    spark: SparkSession, paths: list[str], dialect: Dialect
) -> dict[tuple[str, ...], list[str]]:
    """Group files by their header.

    The driver sees one line per file, the same order of size as the file
    listing Spark keeps there anyway.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, header in _first_lines(spark, paths):
        names = next(csv.reader([header], delimiter=dialect.sep, quotechar=dialect.quote))
        groups[tuple(names)].append(_literal(path))
    return dict(sorted(groups.items()))


def read_by_header(
    spark: SparkSession,
    paths: str | Iterable[str],
    dialect: Dialect = COMMA,
    malformed: str | None = None,
) -> list[DataFrame]:
    """One all-string scan per distinct header among the files.

    ``malformed`` names an extra column holding the raw record of each row with
    too few or too many fields, null for all others.
    """
    frames = []
    for names, files in _files_by_header(spark, _paths(paths), dialect).items():
        # An unnamed or repeated column cannot be addressed; give it a name of
        # its own so the rest of the header stays usable.
        seen: set[str] = set()
        fields = []
        for i, name in enumerate(names):
            unique = name if name.strip() and name not in seen else f"_unnamed{i}"
            seen.add(unique)
            fields.append(T.StructField(unique, T.StringType()))
        if malformed:
            fields.append(T.StructField(malformed, T.StringType()))
        with_header = Dialect(**{**dialect.__dict__, "header": True})
        reader = spark.read.schema(T.StructType(fields)).options(
            # The schema is this very header, so position and name agree.
            **{**with_header.options(), "enforceSchema": "true", "mode": "PERMISSIVE"}
        )
        if malformed:
            reader = reader.option("columnNameOfCorruptRecord", malformed)
            reader = reader.option("columnPruning", "false")
        frames.append(reader.csv(files))
    return frames


def read_union_by_name(
    spark: SparkSession, paths: str | Iterable[str], dialect: Dialect = COMMA
) -> DataFrame:
    """Union files with different headers by column name; absent cells are null."""
    frames = read_by_header(spark, paths, dialect)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

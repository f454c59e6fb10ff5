"""Line-oriented and JSON-lines sources, split loading, path columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths))


def regex_records(
    lines: DataFrame,
    pattern: str,
    names: Iterable[str],
    prefix: tuple[int, str] | None = None,
    strict: bool = False,
    column: str = "value",
) -> DataFrame:
    """Turn matching lines into records, one column per capture group.

    ``prefix`` is ``(start, literal)`` with a 1-based start: only lines holding
    that literal there are looked at. Of those, a line the pattern misses is
    dropped, or is an error when ``strict``.
    """
    value = F.col(column)
    if prefix is not None:
        start, literal = prefix
        # A literal at the very start is a predicate that reaches the files.
        inside = F.substring(value, start, len(literal)) == literal
        lines = lines.filter(value.startswith(literal) if start == 1 else inside)
    if strict:
        value = F.when(value.rlike(pattern), value).otherwise(
            F.raise_error(F.concat(F.lit("line does not match: "), value))
        )
    else:
        lines = lines.filter(value.rlike(pattern))
    keep = [c for c in lines.columns if c != column]
    return lines.select(
        *keep,
        *[F.regexp_extract(value, pattern, i).alias(n) for i, n in enumerate(names, start=1)],
    )


def read_json_records(
    spark: SparkSession, paths: str | Iterable[str], schema: T.StructType | str
) -> DataFrame:
    """JSON lines with a declared, possibly nested, schema; bad lines are errors."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.json(paths if isinstance(paths, str) else list(paths))


def with_path_parts(df: DataFrame, pattern: str, names: Iterable[str]) -> DataFrame:
    """Add columns captured from the path of the file each row came from.

    Call it on a file scan: ``_metadata`` does not survive other operators.
    """
    # The path is percent-encoded; a literal plus sign must stay one.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select(
        "*", *[F.regexp_extract(path, pattern, i).alias(n) for i, n in enumerate(names, start=1)]
    )


def load_splits(splits: Mapping[str, DataFrame], split_column: str | None = "split") -> DataFrame:
    """Concatenate published splits by column name."""
    frames = [
        df.withColumn(split_column, F.lit(name)) if split_column else df
        for name, df in splits.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def _utf7_decoder():
    # Made inside a function, so that it is sent to the workers by value and they
    # need no copy of this package.
    @F.pandas_udf(T.StringType())
    def decode(values: pd.Series) -> pd.Series:
        def one(text: str) -> str:
            try:
                decoded = text.encode("utf8", errors="ignore").decode("utf7", errors="ignore")
                decoded.encode("utf8")
                return decoded
            except UnicodeError:
                return text

        return values.map(one, na_action="ignore")

    return decode


def redecode_utf7(text: Column) -> Column:
    """Repair UTF-7 text stored as UTF-8; text that cannot be repaired is kept.

    Spark has no UTF-7 decoder, so this is one of two Python UDFs here. Only
    values with a shift character or a non-ASCII byte can change; all others
    travel to Python as nulls.
    """
    may_change = text.rlike("[+]|[^\\x00-\\x7F]")
    return F.coalesce(_utf7_decoder()(F.when(may_change, text)), text)

"""Row filters and the hook for user code."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col
from ..functions.labels import parse_number, rescale_percent


def keep_arity(df: DataFrame, fields: str, n: int) -> DataFrame:
    """Keep rows whose array column holds exactly ``n`` fields."""
    return df.filter(F.size(col(fields)) == n)


def keep_parseable(
    df: DataFrame, percents: Iterable[str], required: Iterable[str] = ()
) -> DataFrame:
    """Rescale percent columns; drop rows where one is not a number or a
    required column is missing."""
    percents = list(percents)
    parsed = df.select(
        *[
            rescale_percent(parse_number(col(n))).alias(n) if n in percents else col(n)
            for n in df.columns
        ]
    )
    present = [col(n).isNotNull() for n in [*percents, *required]]
    return parsed.filter(reduce(lambda a, b: a & b, present))


# Helper columns that break ties while rows are ordered.
TIES = ("_tie_hash", "_tie_task")


def with_ties(df: DataFrame) -> DataFrame:
    """Add columns that tell rows with equal keys, even copies, apart.

    Spark orders rows by ranges of the sort key, and rows that agree on all of
    it go to one task. The hash spreads rows of one key, the task number spreads
    copies of one row.
    """
    return df.select(
        "*",
        F.xxhash64(*[col(n) for n in df.columns]).alias(TIES[0]),
        F.spark_partition_id().alias(TIES[1]),
    )


def ordered(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Global order by keys, with a hot key spread over many tasks."""
    return with_ties(df).orderBy(*[col(k) for k in keys], *TIES).drop(*TIES)


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply user code to Arrow batches of rows, without a shuffle."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(each, schema)


def sql_over(views: Mapping[str, DataFrame], query: str) -> DataFrame:
    """Run SQL over frames named in the query as ``{name}``."""
    spark = next(iter(views.values())).sparkSession
    return spark.sql(query, **views)

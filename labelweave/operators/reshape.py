"""Pivot and unpivot.

Every pivot groups by all columns that are neither the label nor the value, so
rows equal on those collapse into one. The cells are conditional aggregates:
Spark's own ``pivot`` shuffles twice (by group and label, then by group), this
form once, and its partial aggregates shrink hot groups before that shuffle.

The label list is always given. A label outside it adds no column, but its row
group stays; ``unknown_labels`` reports what was outside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import col, cols, others


def _pivot(
    df: DataFrame,
    label: str,
    labels: Iterable[str],
    cell: Callable[[Column], Column],
    value: str | None = None,
) -> DataFrame:
    group = others(df, label, *([value] if value else []))
    cells = [cell(col(label) == F.lit(name)).alias(name) for name in labels]
    return df.groupBy(*cols(group)).agg(*cells)


def pivot_count(df: DataFrame, label: str, labels: Iterable[str]) -> DataFrame:
    """Rows per label; zero where a group lacks the label."""
    return _pivot(df, label, labels, lambda hit: F.count(F.when(hit, 1)))


def pivot_flag(df: DataFrame, label: str, labels: Iterable[str]) -> DataFrame:
    """Whether a group has the label: the pivot count as a boolean, never null."""
    return _pivot(df, label, labels, lambda hit: F.coalesce(F.bool_or(hit), F.lit(False)))


def pivot_presence(df: DataFrame, label: str, labels: Iterable[str]) -> DataFrame:
    """True where a group has the label, null elsewhere."""
    return _pivot(df, label, labels, lambda hit: F.bool_and(F.when(hit, True)))


def pivot_sum(df: DataFrame, label: str, labels: Iterable[str], value: str) -> DataFrame:
    return _pivot(df, label, labels, lambda hit: F.sum(F.when(hit, col(value))), value)


def pivot_mean(df: DataFrame, label: str, labels: Iterable[str], value: str) -> DataFrame:
    return _pivot(df, label, labels, lambda hit: F.avg(F.when(hit, col(value))), value)


def pivot_any_value(df: DataFrame, label: str, labels: Iterable[str], value: str) -> DataFrame:
    """A non-null value per cell, null where there is none.

    Any value would do; the largest is taken so that reruns agree.
    """
    return _pivot(df, label, labels, lambda hit: F.max(F.when(hit, col(value))), value)


def unknown_labels(df: DataFrame, label: str, labels: Iterable[str]) -> DataFrame:
    """Labels outside the list, with their row counts; null counts as outside."""
    known = col(label).isin(list(labels))
    return (
        df.filter(~F.coalesce(known, F.lit(False)))
        .groupBy(col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def unpivot(
    df: DataFrame,
    columns: Sequence[str],
    name: str,
    value: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns to rows, leaving null cells out.

    One column needs no expansion of the rows, only a projection.
    """
    ids = others(df, *columns) if keep is None else list(keep)
    if len(columns) == 1:
        only = columns[0]
        long = df.select(*cols(ids), F.lit(only).alias(name), col(only).alias(value))
    else:
        long = df.unpivot(cols(ids), cols(columns), name, value)
    return long.filter(col(value).isNotNull())


def long_to_wide(
    frames: Iterable[DataFrame],
    wide: Callable[..., DataFrame],
    label: str,
    labels: Iterable[str],
    value: str,
) -> DataFrame:
    """Append long frames and pivot them together: one shuffle for all of them."""
    return wide(reduce(DataFrame.union, frames), label, labels, value)

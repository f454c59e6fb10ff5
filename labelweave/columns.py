"""Small helpers for naming columns safely."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Reference a column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def others(df: DataFrame, *names: str) -> list[str]:
    """Names of every column of ``df`` except ``names``, in order."""
    return [n for n in df.columns if n not in names]


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; got {df.columns}")

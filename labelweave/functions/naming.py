"""Projection, renaming and column-name clean-up."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..columns import col


def project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select and rename: ``columns`` maps output name to input name."""
    return df.select(*[col(source).alias(target) for target, source in columns.items()])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[col(n) for n in df.columns if n not in names])


def normalize_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Strip and lower-case column names, apply renames, drop unnamed columns.

    Two columns that end up with one name are an error.
    """
    picked = []
    for name in df.columns:
        clean = name.strip().lower()
        if clean and not clean.startswith("_unnamed"):
            picked.append((name, (renames or {}).get(clean, clean)))
    clash = [n for n, k in Counter(t for _, t in picked).items() if k > 1]
    if clash:
        raise ValueError(f"column names collide after normalisation: {clash}")
    return df.select(*[col(source).alias(target) for source, target in picked])


def title_case(name: str) -> str:
    """First letter upper-case, the rest as it is."""
    return name[:1].upper() + name[1:]

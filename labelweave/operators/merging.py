"""Appends, joins and merge by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..columns import col, cols
from ..session import ensure_checkpoint_dir


def append_by_position(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append rows, matching columns by position and casting to the target's types."""
    if len(target.columns) != len(source.columns):
        raise ValueError(f"cannot append {source.columns} to {target.columns}")
    cast = [
        col(name).cast(field.dataType).alias(field.name)
        for name, field in zip(source.columns, target.schema.fields, strict=True)
    ]
    return target.union(source.select(*cast))


def append_by_name(target: DataFrame, *sources: DataFrame) -> DataFrame:
    """Append rows, matching columns by name."""
    for source in sources:
        target = target.unionByName(source)
    return target


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on shared names.

    No broadcast is forced: Spark broadcasts a side it has measured as small,
    and splits skewed partitions at run time.
    """
    return left.join(right, list(keys), how)


def natural_self_map(
    df: DataFrame, key: str, mapped: Mapping[str, Column], as_join: bool = False
) -> DataFrame:
    """Add columns computed from the row itself.

    ``as_join`` gives them by joining the frame to its own projection on
    ``key``. That drops null keys, and a key on k rows gives k x k of them; use
    it only where the key is unique and the join itself is wanted.
    """
    if not as_join:
        return df.select("*", *[c.alias(n) for n, c in mapped.items()])
    side = df.select(col(key), *[c.alias(n) for n, c in mapped.items()])
    return df.join(side, key)


def full_outer_merge(
    left: DataFrame, right: DataFrame, keys: Sequence[str], coalesce_keys: bool = True
) -> DataFrame:
    """Full outer join of two frames that hold each key once.

    ``coalesce_keys=False`` shows the left keys only, so a row found on the
    right alone has null keys.
    """
    if coalesce_keys:
        return left.join(right, list(keys), "full")
    renamed = right.select(
        *[col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
        *cols([c for c in right.columns if c not in keys]),
    )
    on = [col(k) == F.col(f"_r{i}") for i, k in enumerate(keys)]
    return left.join(renamed, on, "full").drop(*[f"_r{i}" for i in range(len(keys))])


def merge_by_key(
    sources: Sequence[DataFrame], key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Merge partial records by key; a later source overrides an earlier one.

    ``columns`` maps column to type. All sources go through one shuffle, with
    partial aggregates before it, instead of one outer join per source. Within
    a source that repeats a key, the largest value counts.
    """
    aligned = None
    for rank, source in enumerate(sources):
        part = source.select(
            col(key),
            *[
                (col(n) if n in source.columns else F.lit(None)).cast(t).alias(n)
                for n, t in columns.items()
            ],
            F.lit(rank).alias("_rank"),
        )
        aligned = part if aligned is None else aligned.union(part)
    latest = [
        F.max(F.when(col(n).isNotNull(), F.struct("_rank", col(n).alias("v"))))["v"].alias(n)
        for n in columns
    ]
    return aligned.groupBy(col(key)).agg(*latest)


def with_row_position(scan: DataFrame, name: str = "_pos", parquet: bool = False) -> DataFrame:
    """Number the rows of a file scan from 0 in file order, files by path.

    Call it on the scan itself. Parquet rows know their index in the file. For
    other formats the scan is checkpointed with a running id first, so that the
    row counts and the numbering come from the very same rows even if tasks
    are run again. Rows are not gathered: a file is a row of the only window over
    everything, a block a row of the windows within files, and nothing goes through
    the driver.
    """
    path = F.col("_metadata.file_path").alias("_path")
    start = F.col("_metadata.file_block_start").alias("_start")
    if parquet:
        located = scan.select(
            "*", path, F.lit(0).cast("long").alias("_start"), F.col("_metadata.row_index").alias("_row")
        )
        first = F.lit(0).cast("long")
    else:
        ensure_checkpoint_dir(scan.sparkSession)
        located = scan.select(
            "*", path, start, F.monotonically_increasing_id().alias("_row")
        ).checkpoint()
        first = F.min("_row")
    # Blocks start where those before them in their file end, files where files end.
    blocks = located.groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("_n"), first.alias("_first"))
    files = blocks.groupBy("_path").agg(F.sum("_n").alias("_rows"))
    preceding = (Window.unboundedPreceding, -1)
    by_file = Window.orderBy("_path").rowsBetween(*preceding)
    in_file = Window.partitionBy("_path").orderBy("_start").rowsBetween(*preceding)
    shift = F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0)) - F.col("_first")
    shifts = (
        blocks.withColumn("_inside", F.sum("_n").over(in_file))
        .join(files.select("_path", F.sum("_rows").over(by_file).alias("_before")), "_path")
        .select("_path", "_start", shift.alias("_shift"))
    )
    placed = located.join(shifts, ["_path", "_start"])
    return placed.select(*cols(scan.columns), (F.col("_row") + F.col("_shift")).alias(name))


def positional_join(
    left: DataFrame, right: DataFrame, left_parquet: bool = False, right_parquet: bool = False
) -> DataFrame:
    """Put two file scans side by side by row order; the shorter one ends in nulls."""
    a = with_row_position(left, parquet=left_parquet)
    b = with_row_position(right, parquet=right_parquet)
    return a.join(b, "_pos", "full").drop("_pos")

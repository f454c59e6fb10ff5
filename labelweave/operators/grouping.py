"""Grouping: aligned lists, counts, means, sorted distinct keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..columns import col, cols

# Items of one output row: a layout of the result, the same rule for every group.
ITEMS_PER_PART = 1_000_000
# A key with more rows than this is ranked in ranges of about so many.
RANGE_ROWS = 1_000_000


def _joined_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    renamed = right.select(
        *[col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
        *[col(c) for c in right.columns if c not in keys],
    )
    on = [col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, on, how).drop(*[f"_r{i}" for i in range(len(keys))])


def _marks_up_to(marks: Column, place: Column) -> Column:
    """How many of the sorted ``marks`` are at or before ``place``: every so many-th is
    looked at first, so that a row meets about two square roots of their number."""
    step = F.ceil(F.sqrt(F.size(marks))).cast("int")
    coarse = F.transform(F.sequence(F.lit(1), F.size(marks), step), lambda i: F.element_at(marks, i))
    before = F.size(F.filter(coarse, lambda mark: mark <= place))
    around = F.slice(marks, (before - 1) * step + 1, step)
    fine = (before - 1) * step + F.size(F.filter(around, lambda mark: mark <= place))
    return F.when(F.size(marks) == 0, 0).when(before == 0, 0).otherwise(fine)


def _ranked(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], range_rows: int
) -> DataFrame:
    """Add ``_rank``: the row's place within its key, from 0.

    A key is cut into ranges of the order at rows that a hash picks, one in
    ``range_rows``, so every evaluation cuts alike and there are as many ranges as the
    key needs. Ranges are ranked on their own and start where the ones before end.
    """
    place = F.struct(*cols(order))
    marks = (
        rows.filter(F.pmod(F.xxhash64(*cols(order)), F.lit(range_rows)) == 0)
        .groupBy(*cols(keys))
        .agg(F.sort_array(F.collect_set(place)).alias("_marks"))
    )
    found = F.when(F.col("_marks").isNull(), 0).otherwise(_marks_up_to(F.col("_marks"), place))
    placed = _joined_null_safe(rows, marks, keys, "left").withColumn("_range", found).drop("_marks")
    within = Window.partitionBy(*cols(keys), "_range").orderBy(*cols(order))
    before = Window.partitionBy(*cols(keys)).orderBy("_range")
    starts = (
        placed.groupBy(*cols(keys), "_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            *cols(keys),
            "_range",
            F.sum("_size").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("_start"),
        )
    )
    numbered = placed.withColumn("_row", F.row_number().over(within))
    joined = _joined_null_safe(numbered, starts, [*keys, "_range"], "left")
    rank = F.coalesce("_start", F.lit(0)) + F.col("_row") - 1
    return joined.withColumn("_rank", rank).drop("_start", "_row", "_range")


def _field(name: str):
    return lambda item: item[name]


def gather_lists(
    df: DataFrame,
    keys: Sequence[str],
    lists: Mapping[str, str],
    order_by: Sequence[str],
    aggs: Iterable[Column] = (),
    items_per_part: int = ITEMS_PER_PART,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Group rows and collect columns into lists aligned with one another.

    ``lists`` maps output name to input column. Nulls keep their place. The rows of a
    key are ranked by ``order_by`` (then by the listed values) and every
    ``items_per_part`` of them make one row of the result, numbered by ``part`` from 0;
    the parts of a key, put together, are its whole lists in order. ``aggs`` are further
    aggregates over the whole key; they stand on part 0 and are null on others, so that
    nothing is counted twice.

    No job runs when the frame is built. Keys of at most ``range_rows`` rows are
    collected and aggregated in one shuffle. Those with more are told apart by a count
    and ranked in ranges, so that a task collects at most ``items_per_part`` rows of
    them. Of these keys only a hash of eight bytes is broadcast, at most one for every
    ``range_rows`` rows; a key that shares the hash of another just takes the longer
    way. Where no key is that large, its branch falls away at run time. ``range_rows``
    has no effect on the result.
    """
    aggs = list(aggs)
    order = {f"_o{i}": o for i, o in enumerate(order_by)}
    values = {f"_v{i}": v for i, v in enumerate(lists.values())}
    digest = F.xxhash64(*cols(keys))
    counts = df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_n"))
    large = F.broadcast(counts.filter(F.col("_n") > range_rows).select(digest.alias("_large")))
    named = [col(c).alias(n) for n, c in {**order, **values}.items()]

    few = df.join(large, digest == F.col("_large"), "left_anti").groupBy(*cols(keys))
    items = F.sort_array(F.collect_list(F.struct(*named))).alias("_items")
    few = few.agg(items, *aggs)
    sums = [c for c in few.columns if c not in keys and c != "_items"]
    part = F.lit(0)
    if items_per_part < range_rows:
        last = F.floor((F.size("_items") - 1) / items_per_part).cast("int")
        few = few.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
        few = few.withColumn("_items", F.slice("_items", F.col("part") * items_per_part + 1, items_per_part))
        part = F.col("part")

    many = df.join(large, digest == F.col("_large"), "left_semi")
    ranked = _ranked(many.select(*cols(keys), *named), keys, [*order, *values], range_rows)
    at = F.floor(F.col("_rank") / items_per_part).cast("int").alias("part")
    items = F.sort_array(F.collect_list(F.struct("_rank", *values))).alias("_items")
    many_parts = ranked.groupBy(*cols(keys), at).agg(items)

    def taken(parts: DataFrame, part: Column, *more: Column) -> DataFrame:
        made = [F.transform("_items", _field(v)).alias(n) for n, v in zip(lists, values, strict=True)]
        return parts.select(*cols(keys), part.alias("part"), *made, *more)

    whole = [F.when(part == 0, col(c)).alias(c) for c in sums]
    first = taken(few, part, *whole)
    if not aggs:
        return first.unionByName(taken(many_parts, F.col("part")))
    many_sums = many.groupBy(*cols(keys)).agg(*aggs).withColumn("part", F.lit(0))
    rest = _joined_null_safe(taken(many_parts, F.col("part")), many_sums, [*keys, "part"], "left")
    return first.unionByName(rest)


def count_non_null(df: DataFrame, keys: Sequence[str], columns: Iterable[str]) -> DataFrame:
    return df.groupBy(*cols(keys)).agg(*[F.count(col(c)).alias(c) for c in columns])


def means(df: DataFrame, keys: Sequence[str], columns: Iterable[str]) -> DataFrame:
    """Group means; nulls are ignored, a group of nulls gives null."""
    return df.groupBy(*cols(keys)).agg(*[F.avg(col(c)).alias(c) for c in columns])


def sorted_registry(df: DataFrame, key: str, pinned: str | None = None) -> DataFrame:
    """Distinct keys in order, one of them pinned to the first place (``pin`` 0)."""
    pin = F.when(col(key) == F.lit(pinned), 0).otherwise(1)
    return df.select(col(key)).distinct().withColumn("pin", pin).orderBy("pin", col(key))

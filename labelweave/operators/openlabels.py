"""Labels that are not known beforehand: summaries of them, and pivots that lose none.

Which labels become columns is decided by a summary of frequent labels, of bounded size,
that tasks build and merge; it can be stored per part of the data and merged later.
Labels beyond it go to a map column, so every label's cell is in the result, however
many labels there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import col, cols, others, require_columns

# Labels that a summary tracks. Up to three quarters of them it counts exactly; beyond,
# it keeps every label that more than 3.5 / TRACKED of all rows carry.
TRACKED = 4096
# Columns that a pivot makes of labels at most, unless it is told otherwise.
MOST = 64


def label_summary(df: DataFrame, label: str, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """``summary`` of a column's frequent values, one per group of ``by``: mergeable, and
    of a size that ``tracked`` bounds. Nulls are no labels. One aggregate, combined in
    the tasks that read the rows."""
    require_columns(df, [label, *by], "label_summary")
    known = df.filter(col(label).isNotNull()).withColumn(label, col(label).cast("string"))
    made = F.call_function("approx_top_k_accumulate", col(label), F.lit(tracked))
    return known.groupBy(*cols(by)).agg(made.alias("summary"))


def merge_summaries(summaries: DataFrame, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """Summaries of parts to those of groups of ``by``, or of everything."""
    merged = F.call_function("approx_top_k_combine", F.col("summary"), F.lit(tracked))
    return summaries.filter("summary is not null").groupBy(*cols(by)).agg(merged.alias("summary"))


def summarised_labels(summaries: DataFrame, by: Sequence[str] = (), most: int = TRACKED) -> DataFrame:
    """``label`` and ``n_rows`` of the ``most`` frequent labels of each summary."""
    found = F.call_function("approx_top_k_estimate", F.col("summary"), F.lit(most))
    rows = summaries.filter("summary is not null").select(*cols(by), F.explode(found).alias("_found"))
    return rows.select(*cols(by), F.col("_found.item").alias("label"), F.col("_found.count").alias("n_rows"))


def frequent_labels(df: DataFrame, label: str, most: int = MOST, tracked: int = TRACKED) -> list[str]:
    """The ``most`` frequent labels in order of their names; ties go to the lesser name.

    Reads the label column alone; the driver gets at most ``tracked`` names.
    """
    found = summarised_labels(label_summary(df, label, tracked=tracked), most=tracked).collect()
    first = sorted(found, key=lambda r: (-r.n_rows, r.label))[:most]
    return sorted(r.label for r in first)


def _count(hit: Column, value: Column | None) -> dict[str, Column]:
    return {"n": F.count(F.when(hit, 1))}


def _one(function: Callable[[Column], Column]):
    def parts(hit: Column, value: Column | None) -> dict[str, Column]:
        return {"v": function(F.when(hit, value))}

    return parts


def _mean(hit: Column, value: Column | None) -> dict[str, Column]:
    return {"s": F.sum(F.when(hit, value).cast("double")), "n": F.count(F.when(hit, value))}


def _flag(hit: Column, value: Column | None) -> dict[str, Column]:
    return {"v": F.bool_or(hit)}


# Of each kind of cell: its parts per group and label, how parts are put together, the
# value they give, and whether it needs a value column.
KINDS: dict[str, tuple] = {
    "count": (_count, {"n": F.sum}, lambda p: F.coalesce(p["n"], F.lit(0).cast("long")), False),
    "flag": (_flag, {"v": F.bool_or}, lambda p: F.coalesce(p["v"], F.lit(False)), False),
    "sum": (_one(F.sum), {"v": F.sum}, lambda p: p["v"], True),
    "max": (_one(F.max), {"v": F.max}, lambda p: p["v"], True),
    "mean": (_mean, {"s": F.sum, "n": F.sum}, lambda p: p["s"] / F.nullif(p["n"], F.lit(0)), True),
}


def pivot_open(
    df: DataFrame,
    label: str,
    kind: str = "count",
    value: str | None = None,
    labels: Iterable[str] | None = None,
    rest: str = "other",
    most: int = MOST,
) -> DataFrame:
    """Pivot a label column whose values are not all known.

    Groups are the rows equal on all columns but ``label`` and ``value``. ``labels``, by
    default the ``most`` frequent ones, become columns like those of the closed pivots:
    ``count`` and ``flag`` give 0 and false where a group lacks the label, ``sum``,
    ``max`` and ``mean`` null. All other labels of a group are in the map ``rest``, empty
    if there are none. Null labels add neither; their group stays.

    Rows are combined per group and label where they are read, so that a hot group or a
    label on most rows is a row per task in the shuffle; groups are then put together
    from one row for all listed labels and one for each other one.
    """
    if kind not in KINDS:
        raise ValueError(f"kind {kind!r} is not known; choose one of {sorted(KINDS)}")
    parts_of, merge, final, needs_value = KINDS[kind]
    if needs_value != (value is not None):
        raise ValueError(f"kind {kind!r} " + ("needs a value column" if needs_value else "takes no value column"))
    require_columns(df, [label, *([value] if value else [])], "pivot_open")
    group = others(df, label, *([value] if value else []))
    names = frequent_labels(df, label, most) if labels is None else list(labels)
    if taken := {*group} & {*names, rest} | ({rest} & {*names}):
        raise ValueError(f"labels and columns share names: {sorted(taken)}")
    text = col(label).cast("string")
    outside = F.when(~text.isin(names), text) if names else text
    given = col(value) if value else None
    cells = {(n, k): part for n in names for k, part in parts_of(text == F.lit(n), given).items()}
    alone = parts_of(F.col("_label").isNotNull(), given)
    keyed = df.withColumn("_label", outside)
    combined = keyed.groupBy(*cols(group), "_label").agg(
        *[part.alias(f"_{names.index(n)}_{k}") for (n, k), part in cells.items()],
        *[part.alias(f"_rest_{k}") for k, part in alone.items()],
    )
    entry = F.struct(F.col("_label"), final({k: F.col(f"_rest_{k}") for k in alone}).alias("_cell"))
    entries = F.sort_array(F.collect_list(F.when(F.col("_label").isNotNull(), entry)))
    whole = combined.groupBy(*cols(group)).agg(
        *[merge[k](F.col(f"_{i}_{k}")).alias(f"_{i}_{k}") for i in range(len(names)) for k in merge],
        F.map_from_entries(entries).alias("_rest"),
    )
    made = [final({k: F.col(f"_{i}_{k}") for k in merge}).alias(n) for i, n in enumerate(names)]
    return whole.select(*cols(group), *made, F.col("_rest").alias(rest))


def open_vote_counts(
    df: DataFrame,
    annotations: str,
    labels: Iterable[str],
    keep: Iterable[str],
    rest: str = "other",
    unasked: int | None = None,
) -> DataFrame:
    """Count true votes per label in a map of worker to map of label to flag.

    Listed labels are columns, ``unasked`` where no worker was asked; the map ``rest``
    has the true votes of all other labels that were asked about. Folds within the row:
    no explode, no shuffle.
    """
    names, keep = list(labels), list(keep)
    answers = F.filter(F.map_values(col(annotations)), lambda worker: worker.isNotNull())
    votes = F.flatten(F.transform(answers, F.map_entries))
    ballots = df.select(*cols(keep), F.filter(votes, lambda v: v["value"].isNotNull()).alias("_votes"))
    start = F.lit(unasked).cast("long")

    def counted(name: Column) -> Column:
        own = F.filter("_votes", lambda v: v["key"] == name)
        yes = F.size(F.filter(own, lambda v: v["value"])).cast("long")
        return F.when(F.size(own) > 0, yes)

    keys = F.array_distinct(F.transform("_votes", lambda v: v["key"]))
    known = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    more = F.array_sort(F.array_except(keys, known))
    others_ = F.map_from_entries(F.transform(more, lambda n: F.struct(n, counted(n))))
    return ballots.select(
        *cols(keep),
        *[F.coalesce(counted(F.lit(n)), start).alias(n) for n in names],
        F.coalesce(others_, F.create_map().cast("map<string,bigint>")).alias(rest),
    )

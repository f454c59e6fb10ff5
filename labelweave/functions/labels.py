"""Label expressions. All are built-in Spark expressions, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import chain
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import col, cols
from .text import strip_text

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def as_flag(value: Column) -> Column:
    """Number to boolean: non-zero is true, null stays null."""
    return value.cast("boolean")


def null_to(value: Column, default: object) -> Column:
    """Default for a missing label; ``default`` must have the column's type."""
    return F.coalesce(value, F.lit(default))


def flag_if_present(value: Column) -> Column:
    return value.isNotNull()


def row_mean(values: Iterable[Column]) -> Column:
    """Mean over rater columns of one row; null when any rater is missing."""
    values = list(values)
    return reduce(add, values) / F.lit(float(len(values)))


def rescale_percent(value: Column) -> Column:
    """0-100 to 0-1, as a double."""
    return value.cast("double") / F.lit(100.0)


def parse_number(text: Column, type_name: str = "double") -> Column:
    """Parse text as a number; what is not a number becomes null.

    The pattern keeps out literals only a Java parser takes, such as ``5d``.
    """
    if type_name in ("double", "float"):
        text = F.when(text.rlike(_NUMBER), F.trim(text))
    return text.try_cast(type_name)


def map_codes(code: Column, table: Mapping[object, str], strict: bool = False) -> Column:
    """Look a code up in a fixed table; unknown is null, or an error if strict."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.try_element_at(literal, code)
    if not strict:
        return found
    shown = F.coalesce(code.cast("string"), F.lit("NULL"))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unknown label code: "), shown)))


def one_hot(label: Column, labels: Iterable[str]) -> list[Column]:
    """One boolean per label, true where the row carries that label."""
    return [F.coalesce(label == F.lit(name), F.lit(False)).alias(name) for name in labels]


def multi_hot(
    codes: Column, table: Mapping[str, str], sep: str = ",", strict: bool = True
) -> list[Column]:
    """Delimited code list to one boolean per label.

    With ``strict`` a code missing from ``table`` is an error, as is a null list.
    """
    split = F.transform(F.split(codes, sep), strip_text)
    if strict:
        known = F.array(*[F.lit(c) for c in table])
        unknown = F.array_except(split, known)
        split = F.when(F.size(unknown) == 0, split).otherwise(
            F.raise_error(F.concat(F.lit("unknown label code in: "), F.coalesce(codes, F.lit("NULL"))))
        )
    flags: dict[str, list[Column]] = {}
    for code, label in table.items():
        flags.setdefault(label, []).append(F.array_contains(split, code))
    return [
        F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False)).alias(label)
        for label, hits in flags.items()
    ]


def pair_votes(raters: Iterable[Column], labels: Iterable[str]) -> list[Column]:
    """Number of raters that chose each label; a missing rater counts as none."""
    raters = list(raters)
    return [
        reduce(add, [F.when(r == F.lit(name), 1).otherwise(0) for r in raters]).alias(name)
        for name in labels
    ]


def vote_counts(
    df: DataFrame,
    annotations: str,
    labels: Iterable[str],
    keep: Iterable[str],
    unasked: int | None = None,
) -> DataFrame:
    """Count true votes per label in a map of worker to struct of label flags.

    A label no worker was asked about (null in every struct) gives ``unasked``.
    The count folds one flag array per label, within the row: no explode, no
    shuffle. A struct per worker, rather than a map, makes each flag a field
    access instead of a search through the keys.
    """
    keep = list(keep)
    ballots = df.select(*cols(keep), F.map_values(col(annotations)).alias("_ballots"))
    start = F.lit(unasked).cast("long")
    return ballots.select(
        *cols(keep),
        *[F.aggregate(F.col("_ballots")[n], start, _count_vote).alias(n) for n in labels],
    )


def _count_vote(total: Column, vote: Column) -> Column:
    counted = F.coalesce(total, F.lit(0).cast("long")) + vote.cast("long")
    return F.when(vote.isNull(), total).otherwise(counted)

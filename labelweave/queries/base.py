"""Query registry and shaping helpers.

A query takes ``(spark, sf_dir)``. It shapes whole tables into the layout an
operator expects, applies the operator and returns the frame. The SQL beside it
says what the result must be.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = " ".join(sql.split("\n")).strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged_csv(df: DataFrame, folder: str, header: bool = True, **options: str) -> str:
    """Write raw-shaped rows as delimited files for a scan to read."""
    settings = {"header": str(header).lower(), "escape": '"', **options}
    df.write.mode("overwrite").options(**settings).csv(folder)
    return folder


def staging(spark: SparkSession) -> str:
    return shared_folder(spark, "staging")


def pick(labels: Sequence[str], index: Column) -> Column:
    """The label at a 0-based index column."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


# SQL spelling of the helpers above, for the expected results.


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_names(names: Sequence[str], template: str = "{q}") -> str:
    """A select list: ``{q}`` is the quoted name, ``{t}`` the text, ``{i}`` its index."""
    return ", ".join(
        template.format(q='"' + n + '"', t=sql_text(n), i=i) for i, n in enumerate(names)
    )


def sql_pick(labels: Sequence[str], index: str) -> str:
    items = ", ".join(sql_text(x) for x in labels)
    return f"([{items}])[CAST(1 + {index} AS INTEGER)]"


def sql_in(labels: Sequence[str]) -> str:
    return "(" + ", ".join(sql_text(x) for x in labels) + ")"


USER_TEXT_SQL = "'user ' || CAST(user_id AS VARCHAR) || ' ' || event_type"


def user_text() -> Column:
    return F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" "), F.col("event_type"))


def sql_gathered(
    rows: str, key: str, order: str, lists: dict[str, str], aggs: dict[str, str], items: int
) -> str:
    """Aligned lists in parts of ``items``, aggregates on part 0."""
    gathered = ", ".join(f"ARRAY_AGG({v} ORDER BY {order}) AS {n}" for n, v in lists.items())
    sums = ", ".join(f'{v} AS "{n}"' for n, v in aggs.items())
    names = ", ".join([*lists, *(f'a."{n}"' for n in aggs)])
    return (
        f"WITH r AS ({rows}), k AS (SELECT *, CAST((row_number() OVER (PARTITION BY {key} ORDER BY {order}) "
        f"- 1) // {items} AS INTEGER) AS part FROM r), "
        f"p AS (SELECT {key}, part, {gathered} FROM k GROUP BY {key}, part), "
        f"a AS (SELECT {key}, 0 AS part, {sums} FROM r GROUP BY {key}) "
        f"SELECT p.{key}, p.part, {names} FROM p LEFT JOIN a "
        f"ON p.{key} IS NOT DISTINCT FROM a.{key} AND p.part = a.part"
    )

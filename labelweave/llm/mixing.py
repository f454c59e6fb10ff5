"""Mixing sources to target weights by Pareto order sampling.

Everything here is DataFrame code. A mix gives each source a target number of words.
A source's documents are taken in certain whole copies first. The rest of its target is
drawn with inclusion probabilities ``p`` in proportion to size, so that the words drawn
are expected to be that rest; documents for which that would be one or more are certain
too, and the others share what they leave. The others are ranked by random odds over
inclusion odds, ``(u / (1 - u)) / (p / (1 - p))`` with a random number ``u`` each, and
the sample is the head of that ranking. Its size is fixed in words: it ends where the
words come nearest the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..columns import col
from .frames import WORD, carried, frozen, same_row, scanned, with_row_id

WEIGHTS = (5, 2, 1)
# Passes that the SQL of the query spells out; it needs no more on tables of its size.
SQL_PASSES = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*keys: Column) -> Column:
    """A number strictly between 0 and 1 that depends on the keys alone."""
    parts = [F.coalesce(k.cast("string"), F.lit("-")) for k in keys]
    digest = F.substring(F.md5(F.concat_ws("/", *parts).cast("binary")), 1, 12)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(2**48)


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds divided by inclusion odds; certain rows come first, impossible last."""
    odds = (u / (1.0 - u)) / (p / (1.0 - p))
    return F.when(p >= 1.0, F.lit(0.0)).when(p <= 0.0, F.lit(float("inf"))).otherwise(odds)


def inclusion(joined: DataFrame) -> DataFrame:
    """Of each source ``_s``: ``rate``, inclusion probability per word; ``below``, the
    largest size that is not certain (null: all are); ``held``, words of certain ones.

    ``joined`` has source, size and ``left``, the words to be drawn. A source is a row
    per size here, and the sizes that are certain are the largest: one more is, as long
    as the rate that is left for it and all smaller ones makes it so.
    """
    sizes = joined.filter("size > 0").groupBy("source", "size").agg(
        F.count(F.lit(1)).alias("n"), F.first("left").alias("left")
    )
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    up = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    larger = F.sum(F.col("size") * F.col("n")).over(down.rowsBetween(Window.unboundedPreceding, -1))
    squares = F.sum(F.col("size") * F.col("size") * F.col("n")).over(up)
    rated = sizes.withColumns({"held": F.coalesce(larger, F.lit(0)), "squares": squares}).withColumn(
        "rate", (F.col("left") - F.col("held")) / F.col("squares")
    )
    open_ = F.when(F.col("rate") * F.col("size") < 1.0, F.struct("size", "rate", "held"))
    found = rated.groupBy("source").agg(
        F.max(open_).alias("top"), F.sum(F.col("size") * F.col("n")).alias("words")
    )
    return found.select(
        F.col("source").alias("_s"),
        F.col("top.rate").alias("rate"),
        F.col("top.size").alias("below"),
        F.coalesce("top.held", "words").alias("held"),
    )


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number rows from 0 in the order of ``key``, nulls last, without gathering them:
    sort into ranges, count the ranges, number within. One count per range moves."""
    ranged = df.repartitionByRange(F.col(key).asc_nulls_last()).withColumn(
        "_range", F.spark_partition_id()
    )
    rows = frozen(ranged, "ranges")
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(key).asc_nulls_last()))
    return (
        rows.withColumn("_within", within)
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + F.col("_within") - 1)
        .drop("_range", "_start", "_within")
    )


def source_targets(
    rows: DataFrame, weights: Sequence[int] = WEIGHTS, tenths: int = 15, most_copies: int = 2
) -> DataFrame:
    """One row per source: ``source``, ``source_size`` and its ``target`` in words.

    Sources by code point (null last) weigh ``weights`` in turn and share
    ``tenths / 10`` of all words. A target stops at ``most_copies`` times its source,
    and the excess is shared by weight among the others until none is above. Only sums
    over all sources reach the driver.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(sums, "source", "rank")
    turn = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]),
        (F.col("rank") % len(weights) + 1).cast("int"),
    )
    table = frozen(
        ranked.select("source", "source_size", turn.cast("double").alias("weight")), "sources"
    )
    cap = (most_copies * F.col("source_size")).cast("double")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # The level is the words per unit of weight; it rises as capped sources drop out.
    level = 0.0
    while True:
        capped = cap <= F.col("weight") * F.lit(level)
        free, held = table.agg(
            F.sum(F.when(~capped, F.col("weight"))),
            F.sum(F.when(capped, most_copies * F.col("source_size"))),
        ).first()
        if not free:
            break
        higher = (tenths * total - 10 * (held or 0)) / (10.0 * free)
        if higher <= level:
            break
        level = higher
    target = F.least(cap, F.col("weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def plan_mix(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows of (source, size, u, tie).

    ``tie`` orders rows with equal odds. Copies are certain whole ones and at most one
    more, drawn or certain by its size.
    """
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(share)
    joined = rows.join(
        targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    joined = joined.select(
        "*", whole.cast("int").alias("copies"), (F.col("target") - whole * F.col("source_size")).alias("left")
    )
    same = F.col("source").eqNullSafe(F.col("_s"))
    placed = joined.join(inclusion(joined), same, "left").drop("_s")
    certain = (F.col("size") > 0) & (F.col("below").isNull() | (F.col("size") > F.col("below")))
    state = placed.select(
        *[c for c in joined.columns if c != "left"],
        pareto_rank(F.col("u"), F.col("rate") * F.col("size")).alias("odds"),
        (F.col("left") - F.coalesce("held", F.lit(0))).alias("left"),
        certain.alias("drawn"),
    )
    # Ranges of the ranking: a source that holds most rows lies in many.
    ranked = state.repartitionByRange("source", *_ranking(state))
    ranked = ranked.withColumn("range", F.spark_partition_id())
    within = Window.partitionBy("source", "range").orderBy(*_ranking(state))
    state = frozen(ranked.withColumn("pos", F.row_number().over(within)), "mix")
    # A document too long for what is left of the target ends a pass over the ranking; the
    # next pass takes up those that still fit. Each draws one at least of every source
    # that has any, and what is left falls fast. The rows stay as they are written: a pass
    # leaves a line per source, what was left and the place of the last document drawn.
    none = F.array().cast("array<struct<left:double,last:struct<range:int,pos:int>>>")
    marks = state.groupBy(F.col("source").alias("_s")).agg(F.first("left").alias("_left"))
    marks = frozen(marks.withColumn("passes", none), "marks")
    while _marked(state, marks).filter(_fits()).limit(1).count():
        marks = frozen(_pass(state, marks), "marks")
    return (
        _marked(state, marks)
        .withColumn("copies", F.col("copies") + F.col("drawn").cast("int"))
        .drop("odds", "left", "drawn", "range", "pos")
    )


def _ranking(state: DataFrame) -> list[Column]:
    """By odds; ties by key, and rows with one key by the rows they are."""
    rows = [F.col(c) for c in ("rid_a", "rid_b") if c in state.columns]
    return [F.col("odds"), F.col("tie").asc_nulls_last(), *rows]


def _fits() -> Column:
    return ~F.col("drawn") & (F.col("size") > 0) & (F.col("size") < 2 * F.col("left"))


def _place() -> Column:
    return F.struct("range", "pos")


def _marked(state: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows with what is left to draw and whether they are drawn after the passes in ``marks``."""
    drawn = F.exists("passes", lambda p: (F.col("size") < 2 * p["left"]) & (_place() <= p["last"]))
    same = F.col("source").eqNullSafe(F.col("_s"))
    return state.join(marks, same).select(
        *[c for c in state.columns if c not in ("left", "drawn")],
        F.col("_left").alias("left"),
        (F.col("drawn") | ((F.col("size") > 0) & drawn)).alias("drawn"),
    )


def _pass(state: DataFrame, marks: DataFrame) -> DataFrame:
    """``marks`` after one more pass: it draws the head of the ranking of rows that fit
    what is left."""
    open_ = _marked(state, marks).filter(_fits())
    sums = open_.groupBy("source", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_s"),
        F.col("range").alias("_r"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"),
    )
    running = F.sum("size").over(
        Window.partitionBy("source", "range")
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = open_.withColumn("running", running).join(
        starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r"))
    )
    # The last document may overshoot if that comes nearer than stopping before it.
    end = F.col("start") + F.col("running")
    now = ranked.filter(end - F.col("size") / 2.0 <= F.col("left"))
    got = now.groupBy("source").agg(F.sum("size").alias("got"), F.max(_place()).alias("last"))
    one = F.array(F.struct(F.col("_left").alias("left"), "last"))
    return marks.join(got, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "_s",
        (F.col("_left") - F.coalesce("got", F.lit(0))).alias("_left"),
        F.when(F.col("got").isNull(), F.col("passes")).otherwise(F.concat("passes", one)).alias("passes"),
    )


def mix(
    df: DataFrame,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    tenths: int = 15,
) -> DataFrame:
    """Repeat or drop rows of ``df`` so that its sources reach their targets.

    Returns the columns of ``df``, whatever their names; a row occurs once per copy.
    Random numbers depend on the key and the words' count alone, so reruns agree.
    Null sources are a source of their own; null and empty texts have no words and
    come in certain copies only; rows that repeat are drawn one by one; an empty
    frame gives an empty frame.
    """
    scan = scanned(df)
    copies = plan_mix(*_facts(scan, source, text, key, weights, tenths))
    copies = copies.filter("copies > 0").select(
        F.col("rid_a").alias("_a"), F.col("rid_b").alias("_b"), F.col("copies").alias("_copies")
    )
    out = carried(scan).join(copies, same_row())
    return out.select("row", F.explode(F.sequence(F.lit(1), "_copies"))).select("row.*")


def _facts(scan, source, text, key, weights, tenths):
    facts = with_row_id(
        scan,
        source=source,
        size=word_count(col(text)),
        u=uniform(col(key)),
        tie=key,
    )
    facts = frozen(facts, "sizes")
    return facts, source_targets(facts, weights, tenths)


def op1(df: DataFrame) -> DataFrame:
    """Every document, its size, its source's size and target, and the words taken."""
    facts, targets = _facts(scanned(df), "source", "text", "doc_id", WEIGHTS, 15)
    plan = plan_mix(facts, targets)
    return plan.select(
        F.col("tie").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


_PASS_SQL = """
f{i} AS (SELECT *, CASE WHEN NOT drawn AND size > 0 AND size < 2 * lft THEN size ELSE 0 END AS w FROM s{i}),
r{i} AS (SELECT *, sum(w) OVER (PARTITION BY source ORDER BY odds, doc_id NULLS LAST
    ROWS UNBOUNDED PRECEDING) AS run FROM f{i}),
m{i} AS (SELECT *, w > 0 AND run - size / 2.0::DOUBLE <= lft AS now FROM r{i}),
s{j} AS (SELECT doc_id, source, size, source_size, target, whole, odds, drawn OR now AS drawn,
    lft - coalesce(sum(CASE WHEN now THEN size END) OVER (PARTITION BY source), 0) AS lft FROM m{i}),
"""

OP1_SQL = (
    """
WITH d AS (SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-')), 1, 12))::BIGINT::DOUBLE + 0.5)
        / 281474976710656.0::DOUBLE AS u FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS ssize FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM t),
o AS (SELECT *, row_number() OVER (ORDER BY 2 * ssize / weight, source NULLS LAST) AS k FROM w),
l AS (SELECT *, (15 * sum(ssize) OVER () - 10 * coalesce(sum(2 * ssize) OVER (ORDER BY k
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (10.0::DOUBLE * sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM o),
v AS (SELECT coalesce((SELECT level FROM l WHERE (2 * ssize)::DOUBLE > weight * level ORDER BY k LIMIT 1), 0) AS c),
g AS (SELECT source, ssize AS source_size, least((2 * ssize)::DOUBLE, weight * c) AS target FROM w, v),
j AS (SELECT d.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS share
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
b AS (SELECT *, floor(share) AS whole, target - floor(share) * source_size AS rest FROM j),
n AS (SELECT source, size, count(*) AS n, any_value(rest) AS rest FROM b WHERE size > 0 GROUP BY source, size),
q AS (SELECT *, coalesce(sum(size * n) OVER (PARTITION BY source ORDER BY size DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS held, (sum(size * size * n) OVER (PARTITION BY source
    ORDER BY size ROWS UNBOUNDED PRECEDING))::BIGINT AS squares FROM n),
e AS (SELECT source, max(size) FILTER ((rest - held) / squares * size < 1) AS below,
    max_by((rest - held) / squares, size) FILTER ((rest - held) / squares * size < 1) AS rate,
    coalesce(max_by(held, size) FILTER ((rest - held) / squares * size < 1), sum(size * n))::BIGINT AS held
    FROM q GROUP BY source),
p AS (SELECT b.*, e.rate * size AS p, rest - coalesce(e.held, 0) AS lft,
    size > 0 AND (below IS NULL OR size > below) AS drawn
    FROM b LEFT JOIN e ON b.source IS NOT DISTINCT FROM e.source),
s0 AS (SELECT doc_id, source, size, source_size, target, whole, lft, drawn, CASE WHEN p IS NULL OR p >= 1 THEN 0
    WHEN p <= 0 THEN 'inf'::DOUBLE ELSE (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)) END AS odds FROM p),
"""
    + "".join(_PASS_SQL.format(i=i, j=i + 1) for i in range(SQL_PASSES))
    + f"z AS (SELECT * FROM s{SQL_PASSES}) "
    "SELECT doc_id, size, source_size, target, ((whole + drawn::INT) * size)::BIGINT AS taken FROM z"
)

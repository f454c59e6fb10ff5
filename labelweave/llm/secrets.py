"""Secret scans over a trigram inverted index.

Everything here is DataFrame code. A rule is a regular expression; what its matches must
contain, a Boolean query of trigrams in disjunctive form, is derived from it
(``trigrams.py``). The index maps each trigram that any rule asks for to
the rows that contain it. A rule's candidates are the rows that hold all trigrams of
one of its alternatives; only they are verified with the expression. A rule without
mandatory trigrams scans all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import carried, same_row, scanned, with_row_id
from .trigrams import repeated_class, required


@dataclass(frozen=True)
class Rule:
    """``group`` is the capture that must have at least ``least`` characters; shorter
    matches count as found, and are then dropped.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    def trigrams(self) -> list[list[str]]:
        """Alternatives of mandatory trigrams; none if a match need not have any."""
        return required(self.pattern)

    def guard(self) -> str | None:
        """What a text must match to hold a match that is long enough: for runs of one
        class of characters, a run of ``least``. It is looked for before runs are cut."""
        return repeated_class(self.pattern, self.least) if self.group == 0 else None


BASE = (
    Rule(
        "assign",
        "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=8,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=16),
    Rule("hex", "[0-9a-f]+", least=32),
)
EXTRA = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + EXTRA

def build_index(rows: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Postings (``trigram``, ``rid_a``, ``rid_b``) of the trigrams the rules ask for.

    Trigrams are looked up in the lower-cased whole text; null texts have none.
    """
    wanted = sorted({t for rule in rules for terms in rule.trigrams() for t in terms})
    if not wanted:
        return rows.select(F.lit("").alias("trigram"), "rid_a", "rid_b").limit(0)
    text = F.col("low")
    present = F.array_compact(
        F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in wanted])
    )
    low = rows.select("rid_a", "rid_b", F.lower("text").alias("low"))
    return low.select(F.explode(present).alias("trigram"), "rid_a", "rid_b")


def candidates(spark: SparkSession, index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows that satisfy a rule's Boolean query: ``rid_a``, ``rid_b``, ``kinds``.

    Postings are intersected per row, not per trigram: a trigram that most rows hold
    makes no large group. The query table has a row per trigram of a rule's alternative,
    so the rules bound its size.
    """
    terms = [
        (rule.kind, f"{rule.kind}{n}", t, len(alternative))
        for rule in rules
        for n, alternative in enumerate(rule.trigrams())
        for t in alternative
    ]
    query = spark.createDataFrame(terms, "kind string, alternative string, trigram string, need int")
    hits = index.join(F.broadcast(query), "trigram")
    # One bit per rule and alternative would do; counts keep it plain.
    met = hits.groupBy("rid_a", "rid_b", "kind", "alternative", "need").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        met.filter("n = need")
        .groupBy("rid_a", "rid_b")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def matches(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, kind, end) of the rule's matches, code points.

    Splitting at the expression gives what lies between matches, so positions are
    running sums of the lengths of both.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    items = F.arrays_zip(
        F.transform(found, F.length).alias("n"),
        F.transform(held, F.length).alias("held"),
        F.slice(gaps, 1, F.size(found)).alias("gap"),
    )
    empty = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(state, item):
        begin = state["at"] + item["gap"]
        end = begin + item["n"]
        span = F.struct(
            begin.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"),
            end.alias("end"),
        )
        kept = F.when(item["held"] >= rule.least, F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), kept.otherwise(state["spans"]).alias("spans"))

    return F.coalesce(F.aggregate(items, start, step, lambda s: s["spans"]), empty)


def scan(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Add ``spans``: all matches by start, then rule, as (start, order, kind, end).

    A null or empty text has no spans. Rows that repeat are scanned one by one; columns
    of ``df`` stay, whatever their names, but ``spans``. An empty frame stays empty.
    """
    scan = scanned(df)
    texts = with_row_id(scan, text=text)
    kinds = candidates(df.sparkSession, build_index(texts, rules), rules).select(
        F.col("rid_a").alias("_a"), F.col("rid_b").alias("_b"), F.col("kinds").alias("_kinds")
    )
    flagged = carried(scan).join(kinds, same_row(), "left")
    body = F.coalesce(F.col("row").getField(text), F.lit(""))
    empty = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    parts = []
    for order, rule in enumerate(rules):
        if rule.trigrams():
            verify = F.array_contains("_kinds", rule.kind)
        elif rule.guard():
            verify = body.rlike(rule.guard())
        else:
            verify = F.lit(True)
        parts.append(F.when(verify, matches(body, rule, order)).otherwise(empty))
    spans = F.array_sort(F.concat(*parts))
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != "spans"]
    return flagged.select(*kept, spans.alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def op7(df: DataFrame) -> DataFrame:
    """Counts and digest of the base rules' spans, and the spans of all rules."""
    found = scan(df.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["order"] < len(BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _kind_sql(rule: Rule, order: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    fine = f"len(h[i]) >= {rule.least}"
    return f"""
k{order} AS (SELECT r, [{{'s': len(array_to_string(g[:i], '')) + len(array_to_string(m[:i-1], '')),
    'o': {order}, 'e': len(array_to_string(g[:i], '')) + len(array_to_string(m[:i], '')), 'k': '{rule.kind}'}}
    FOR i IN range(1, len(m) + 1) IF {fine}] AS x
  FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS h,
    string_split_regex(t, '{pattern}') AS g FROM d))"""


def _sql() -> str:
    parts = ",".join(_kind_sql(rule, i) for i, rule in enumerate(RULES))
    everything = " || ".join(f"k{i}.x" for i in range(len(RULES)))
    joins = " ".join(f"JOIN k{i} USING (r)" for i in range(len(RULES)))
    text = "array_to_string([v.k || ':' || v.s || ':' || v.e FOR v IN {}], ',')"
    counts = ", ".join(
        f"len([v FOR v IN s IF v.k = '{rule.kind}'])::BIGINT AS n_{rule.kind}" for rule in BASE
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),{parts},
a AS (SELECT doc_id, list_sort({everything}) AS s FROM d {joins})
SELECT doc_id, {counts},
  sha256(coalesce({text.format(f"[v FOR v IN s IF v.o < {len(BASE)}]")}, '')) AS base_sha256,
  coalesce({text.format("s")}, '') AS spans FROM a"""


OP7_SQL = _sql()

"""Scans: rows are written to the shared folder first, then read by the scan."""

from __future__ import annotations

import base64

from pyspark.sql import functions as F

from ..columns import col
from ..functions import vote_counts
from ..operators import open_vote_counts, sql_over
from ..sinks import read_dataset, write_dataset
from ..sources import (
    Dialect,
    load_splits,
    read_delimited,
    read_header_cast,
    read_headerless,
    read_json_records,
    read_lines,
    read_union_by_name,
    redecode_utf7,
    regex_records,
    rejected_rows,
    scan_with_rejects,
    with_path_parts,
)
from .base import query, staged_csv, staging, table

# Rows without line breaks inside: files stay splittable.
PLAIN = Dialect(multi_line=False)


@query("scan_explicit_schema", "SELECT event_id, event_type, CAST(value AS FLOAT) AS value FROM events")
def scan_explicit_schema(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    path = staged_csv(rows, staging(spark))
    return read_delimited(spark, path, "event_id bigint, event_type string, value float", PLAIN)


@query(
    "scan_header_cast",
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(quality AS INTEGER) AS quality, "
    "CAST(toxic AS INTEGER) AS toxic FROM labels",
)
def scan_header_cast(spark, sf_dir):
    path = staged_csv(table(spark, sf_dir, "labels"), staging(spark))
    return read_header_cast(spark, path, "doc_id bigint, quality int, toxic int", PLAIN)


@query("scan_headerless", "SELECT event_id AS id, event_type AS emotion, value AS intensity FROM events")
def scan_headerless(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    path = staged_csv(rows, staging(spark), header=False)
    return read_headerless(spark, path, "id bigint, emotion string, intensity double", PLAIN)


@query("scan_dialect", "SELECT p_partkey, p_name, p_retailprice FROM part")
def scan_dialect(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    path = staged_csv(rows, staging(spark), sep="\t", quote="`", escape="\\", quoteAll="true")
    dialect = Dialect(sep="\t", quote="`", escape="\\", multi_line=False)
    schema = "p_partkey bigint, p_name string, p_retailprice double"
    return read_delimited(spark, path, schema, dialect)


@query("scan_null_token", "SELECT event_id, NULLIF(event_type, 'error') AS event_type FROM events")
def scan_null_token(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    path = staged_csv(rows, staging(spark))
    dialect = Dialect(null_token="error", multi_line=False)
    return read_delimited(spark, path, "event_id bigint, event_type string", dialect)


@query(
    "scan_tolerant_drop",
    "SELECT event_id, value FROM events WHERE event_type NOT IN ('error', 'signup')",
)
def scan_tolerant_drop(spark, sf_dir):
    # Errors lose their last field, sign-ups have one too many.
    lines = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.col("event_id").cast("string"))
        .when(F.col("event_type") == "signup", F.concat_ws("|", "event_id", "value", "user_id"))
        .otherwise(F.concat_ws("|", "event_id", "value"))
        .alias("line")
    )
    path = staging(spark)
    lines.write.text(path)
    dialect = Dialect(sep="|", multi_line=False)
    return read_headerless(spark, path, "event_id bigint, value double", dialect, bad_rows="drop")


@query(
    "scan_rejects",
    "SELECT CASE event_type WHEN 'view' THEN 'user_id is no bigint' ELSE 'number of fields' END AS reason, "
    "CAST(event_id AS VARCHAR) || CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN '|n/a' "
    "ELSE '|' || CAST(user_id AS VARCHAR) || '|more' END AS record FROM events "
    "WHERE event_type IN ('error', 'signup', 'view')",
)
def scan_rejects(spark, sf_dir):
    # Errors lack a field, sign-ups have one too many, views no number.
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    lines = table(spark, sf_dir, "events").select(
        F.when(kind == "error", number)
        .when(kind == "signup", F.concat_ws("|", number, "user_id", F.lit("more")))
        .when(kind == "view", F.concat_ws("|", number, F.lit("n/a")))
        .otherwise(F.concat_ws("|", number, "user_id"))
        .alias("line")
    )
    path = staging(spark)
    lines.write.text(path)
    dialect = Dialect(sep="|", header=False, multi_line=False)
    scan = scan_with_rejects(spark, path, "event_id bigint, user_id bigint", dialect)
    return rejected_rows(scan).drop("file")


@query(
    "scan_glob_union",
    "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id AS id, text FROM benchmark",
)
def scan_glob_union(spark, sf_dir):
    base = staging(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    staged_csv(docs, f"{base}/a", quoteAll="true")
    staged_csv(items, f"{base}/b", quoteAll="true")
    return read_delimited(spark, f"{base}/*/*.csv", "id bigint, text string")


@query("scan_quoted_breaks", "SELECT doc_id AS id, text, source FROM documents")
def scan_quoted_breaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    path = staged_csv(docs, staging(spark), quoteAll="true")
    return read_delimited(spark, path, "id bigint, text string, source string", Dialect(split=True))


@query(
    "scan_union_by_name",
    "SELECT doc_id, text, lang, NULL::BIGINT AS page_id FROM documents "
    "UNION ALL BY NAME SELECT page_id, url AS text FROM pages",
)
def scan_union_by_name(spark, sf_dir):
    base = staging(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("text"))
    staged_csv(docs, f"{base}/a", quoteAll="true")
    staged_csv(pages, f"{base}/b", quoteAll="true")
    both = read_union_by_name(spark, f"{base}/*/*.csv")
    return both.select(
        col("doc_id").cast("bigint"), "text", "lang", col("page_id").cast("bigint")
    )


VOTE_SQL = """
SELECT 'order ' || CAST(l_orderkey AS VARCHAR) || ' line ' || CAST(l_linenumber AS VARCHAR) AS text,
CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity > 25 AS BIGINT) + CAST(l_discount > 0.05 AS BIGINT) {end} AS "A",
CAST(l_tax > 0.04 AS BIGINT) + CASE WHEN l_returnflag = 'N'
THEN CAST(l_quantity > 25 AS BIGINT) + CAST(l_discount > 0.05 AS BIGINT) ELSE 0 END AS "N",
CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity > 25 AS BIGINT) + CAST(l_discount > 0.05 AS BIGINT) {end} AS "R"
FROM lineitem"""


VOTE_LABELS = ("A", "N", "R")


def _ballots(spark, sf_dir):
    """Each line item as a text with the ballots of three workers."""

    def on_own_flag(vote):
        # This worker is asked about the label the line carries, and no other.
        asked = [F.when(F.col("l_returnflag") == n, vote).alias(n) for n in VOTE_LABELS]
        return F.struct(*asked)

    nothing = F.lit(None).cast("boolean")
    only_n = F.struct(nothing.alias("A"), (F.col("l_tax") > 0.04).alias("N"), nothing.alias("R"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(
            F.lit("order "),
            F.col("l_orderkey").cast("string"),
            F.lit(" line "),
            F.col("l_linenumber").cast("string"),
        ).alias("text"),
        F.create_map(
            F.lit("w1"),
            on_own_flag(F.col("l_quantity") > 25),
            F.lit("w2"),
            on_own_flag(F.col("l_discount") > 0.05),
            F.lit("w3"),
            only_n,
        ).alias("annotations"),
    )


@query("scan_jsonl_nested_votes", VOTE_SQL.format(end="END"))
def scan_jsonl_nested_votes(spark, sf_dir):
    path = staging(spark)
    _ballots(spark, sf_dir).write.json(path)
    schema = "text string, annotations map<string, struct<A: boolean, N: boolean, R: boolean>>"
    lines = read_json_records(spark, path, schema)
    return vote_counts(lines, "annotations", VOTE_LABELS, keep=["text"])


@query("nested_vote_count", VOTE_SQL.format(end="ELSE 0 END"))
def nested_vote_count(spark, sf_dir):
    ballots = _ballots(spark, sf_dir)
    return vote_counts(ballots, "annotations", VOTE_LABELS, keep=["text"], unasked=0)


@query(
    "open_vote_count",
    VOTE_SQL.format(end="END").replace(' AS "R"', " AS r", 1).replace("SELECT 'order '", "SELECT * EXCLUDE (r), "
    "COALESCE('R=' || CAST(r AS VARCHAR), '') AS other FROM (SELECT 'order '", 1) + ")",
)
def open_vote_count(spark, sf_dir):
    """Two labels are listed, the third is among the others."""
    flag = F.col("l_returnflag")
    workers = {
        "w1": F.create_map(flag, F.col("l_quantity") > 25),
        "w2": F.create_map(flag, F.col("l_discount") > 0.05),
        "w3": F.create_map(F.lit("N"), F.col("l_tax") > 0.04),
    }
    ballots = table(spark, sf_dir, "lineitem").select(
        F.format_string("order %d line %d", F.col("l_orderkey"), F.col("l_linenumber")).alias("text"),
        F.create_map(*[x for w, votes in workers.items() for x in (F.lit(w), votes)]).alias("annotations"),
    )
    counted = open_vote_counts(ballots, "annotations", VOTE_LABELS[:2], keep=["text"])
    entries = F.transform(F.map_entries("other"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return counted.withColumn("other", F.array_join(entries, ","))


@query(
    "scan_json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def scan_json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


@query("scan_regex_records", "SELECT o_orderkey AS id, o_orderpriority AS text FROM orders")
def scan_regex_records(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        F.format_string(
            '<instance id="%d">%s</instance>', F.col("o_orderkey"), F.col("o_orderpriority")
        ).alias("value")
    )
    junk = table(spark, sf_dir, "customer").select(
        F.format_string("<customer>%s</customer>", F.col("c_name")).alias("value")
    )
    path = staging(spark)
    records.union(junk).write.text(path)
    found = regex_records(
        read_lines(spark, path),
        r'^<instance id="(.*?)">(.*?)</instance>',
        ("id", "text"),
        prefix=(2, "instance"),
    )
    return found.select(F.col("id").cast("bigint"), "text")


@query(
    "split_concat",
    "SELECT doc_id AS id, text, 'train' AS split FROM documents "
    "UNION ALL SELECT conv_id, text, 'validation' FROM conversations "
    "UNION ALL SELECT item_id, text, 'test' FROM benchmark",
)
def split_concat(spark, sf_dir):
    keys = {"train": ("documents", "doc_id"), "validation": ("conversations", "conv_id")}
    keys["test"] = ("benchmark", "item_id")
    return load_splits(
        {
            split: table(spark, sf_dir, name).select(F.col(key).alias("id"), "text")
            for split, (name, key) in keys.items()
        }
    )


@query(
    "scan_path_columns",
    "SELECT doc_id, source AS author, lang AS story, n_chars FROM documents",
)
def scan_path_columns(spark, sf_dir):
    path = staging(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", "lang")
    docs.write.partitionBy("source", "lang").csv(path)
    scan = read_headerless(spark, f"{path}/*/*/*.csv", "doc_id bigint, n_chars bigint", PLAIN)
    placed = with_path_parts(scan, r"source=([^/]+)/lang=([^/]+)/[^/]+$", ["author", "story"])
    return placed.select("doc_id", "author", "story", "n_chars")


def utf7_letter(letter: str) -> str:
    return "+" + base64.b64encode(letter.encode("utf-16-be")).decode().rstrip("=") + "-"


@query(
    "text_redecode",
    "SELECT unnest(string_split(text, chr(10))) AS repaired FROM documents",
)
def text_redecode(spark, sf_dir):
    # Texts hold their plus signs and accented letters the way a UTF-7 file would.
    encoded = F.replace("text", F.lit("+"), F.lit("+-"))
    for letter in "äçèéêíñóößü":
        for form in dict.fromkeys((letter, letter.upper())):
            if len(form) == 1:
                encoded = F.replace(encoded, F.lit(form), F.lit(utf7_letter(form)))
    path = staging(spark)
    table(spark, sf_dir, "documents").select(encoded.alias("value")).write.text(path)
    return read_lines(spark, path).select(redecode_utf7(F.col("value")).alias("repaired"))


@query("dataset_roundtrip", "SELECT doc_id, text, lang FROM documents")
def dataset_roundtrip(spark, sf_dir):
    path = staging(spark)
    write_dataset(table(spark, sf_dir, "documents"), path)
    return read_dataset(spark, path, ["doc_id", "text", "lang"])


@query("sql_over_view", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def sql_over_view(spark, sf_dir):
    views = {"events": table(spark, sf_dir, "events")}
    return sql_over(views, "SELECT event_type, COUNT(*) AS n FROM {events} GROUP BY event_type")

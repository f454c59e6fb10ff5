"""Projections, label and text functions, joins, pivots and grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from ..columns import col
from ..functions import (
    as_flag,
    collapse_punctuation,
    detokenize,
    drop_columns,
    drop_inline_tag,
    flag_if_present,
    html_unescape,
    join_middle,
    left_strip_chars,
    map_codes,
    multi_hot,
    normalize_columns,
    null_to,
    one_hot,
    pair_votes,
    parse_number,
    project,
    rescale_percent,
    row_mean,
    split_item,
    strip_text,
    tagged,
    title_case,
)
from ..functions.text import DETOKENIZING
from ..operators.grouping import ITEMS_PER_PART
from ..operators import (
    append_by_name,
    append_by_position,
    count_non_null,
    full_outer_merge,
    gather_lists,
    join_on,
    keep_arity,
    keep_parseable,
    label_summary,
    long_to_wide,
    map_batches,
    means,
    merge_by_key,
    merge_summaries,
    natural_self_map,
    ordered,
    pivot_any_value,
    pivot_count,
    pivot_flag,
    pivot_mean,
    pivot_open,
    pivot_presence,
    pivot_sum,
    positional_join,
    sorted_registry,
    summarised_labels,
    unpivot,
)
from ..plans.records import XED_CODES
from ..sources import read_delimited, regex_records
from .base import query, sql_gathered, sql_in, sql_names, sql_text, staged_csv, staging, table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENTS_IN = sql_in(EVENT_TYPES)
DOCS_LABELS_SQL = "documents d LEFT JOIN labels l USING (doc_id)"


def docs_with_labels(spark, sf_dir, *columns):
    docs = table(spark, sf_dir, "documents").select("doc_id", *columns)
    return join_on(docs, table(spark, sf_dir, "labels"), ["doc_id"], "left")


# --- projections, filters ------------------------------------------------------


@query(
    "project_rename",
    'SELECT doc_id AS id, text AS "original text", source AS "group" FROM documents',
)
def project_rename(spark, sf_dir):
    names = {"id": "doc_id", "original text": "text", "group": "source"}
    return project(table(spark, sf_dir, "documents"), names)


@query("drop_columns", "SELECT * EXCLUDE (props) FROM events")
def drop_columns_(spark, sf_dir):
    return drop_columns(table(spark, sf_dir, "events"), "props")


@query(
    "cast_bool",
    "SELECT doc_id, CAST(quality AS BOOLEAN) AS quality, CAST(toxic AS BOOLEAN) AS toxic FROM labels",
)
def cast_bool(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", *[as_flag(col(n)).alias(n) for n in ("quality", "toxic")])


@query(
    "default_null_label",
    f"SELECT d.doc_id, IFNULL(CAST(l.quality AS BOOLEAN), false) AS quality FROM {DOCS_LABELS_SQL}",
)
def default_null_label(spark, sf_dir):
    quality = null_to(as_flag(col("quality")), False)
    return docs_with_labels(spark, sf_dir).select("doc_id", quality.alias("quality"))


@query(
    "presence_flag",
    f"SELECT d.doc_id, if(l.toxic IS NULL, false, true) AS labelled FROM {DOCS_LABELS_SQL}",
)
def presence_flag(spark, sf_dir):
    labelled = flag_if_present(col("toxic")).alias("labelled")
    return docs_with_labels(spark, sf_dir).select("doc_id", labelled)


@query(
    "row_mean",
    "SELECT l_orderkey, l_linenumber, (l_discount + l_tax) / 2.0 AS score FROM lineitem",
)
def row_mean_(spark, sf_dir):
    score = row_mean([col("l_discount"), col("l_tax")]).alias("score")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", score)


@query("rescale_percent", "SELECT event_id, value / 100 AS value FROM events")
def rescale_percent_(spark, sf_dir):
    value = rescale_percent(col("value")).alias("value")
    return table(spark, sf_dir, "events").select("event_id", value)


@query(
    "map_codes",
    "SELECT o_orderkey, map_extract(MAP {'F': 'finished', 'O': 'open'}, o_orderstatus)[1] AS status "
    "FROM orders",
)
def map_codes_(spark, sf_dir):
    status = map_codes(col("o_orderstatus"), {"F": "finished", "O": "open"})
    return table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"))


@query(
    "map_codes_strict",
    "SELECT o_orderkey, map_extract(MAP {'F': 'finished', 'O': 'open', 'P': 'pending'}, "
    "o_orderstatus)[1] AS status FROM orders",
)
def map_codes_strict(spark, sf_dir):
    codes = {"F": "finished", "O": "open", "P": "pending"}
    status = map_codes(col("o_orderstatus"), codes, strict=True)
    return table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"))


@query(
    "one_hot_label",
    "SELECT event_id, "
    + ", ".join(f"event_type = '{e}' AS \"{e}\"" for e in EVENT_TYPES)
    + " FROM events",
)
def one_hot_label(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", *one_hot(col("event_type"), EVENT_TYPES)
    )


@query(
    "multi_hot_label_list",
    "SELECT doc_id, "
    + ", ".join(
        f"doc_id % 9 + 1 = {code} OR n_chars % 4 + 1 = {code} AS \"{label}\""
        for code, label in XED_CODES.items()
    )
    + " FROM documents",
)
def multi_hot_label_list(spark, sf_dir):
    codes = F.concat_ws(
        ", ", (F.col("doc_id") % 9 + 1).cast("string"), (F.col("n_chars") % 4 + 1).cast("string")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", codes.alias("codes"))
    return docs.select("doc_id", *multi_hot(col("codes"), XED_CODES))


@query(
    "vote_sum_pairs",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"CAST(l_returnflag = '{x}' AS INTEGER) + CAST(l_linestatus = '{x}' AS INTEGER) AS \"{x}\""
        for x in "AFNOR"
    )
    + " FROM lineitem",
)
def vote_sum_pairs(spark, sf_dir):
    votes = pair_votes([col("l_returnflag"), col("l_linestatus")], "AFNOR")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *votes)


@query("normalize_columns", "SELECT doc_id, text, lang FROM documents")
def normalize_columns_(spark, sf_dir):
    drifted = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias(" Doc_ID"),
        F.col("text").alias("Content "),
        F.col("lang").alias("LANG"),
        F.col("source").alias(" "),
    )
    return normalize_columns(drifted, {"content": "text"})


@query(
    "filter_malformed_arity",
    "SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents "
    "WHERE len(string_split(text, chr(10))) = 2",
)
def filter_malformed_arity(spark, sf_dir):
    lines = F.split("text", "\n").alias("lines")
    return keep_arity(table(spark, sf_dir, "documents").select("doc_id", lines), "lines", 2)


@query(
    "filter_unparseable_numeric",
    "SELECT event_id, value / 100 AS v FROM events WHERE event_type <> 'error'",
)
def filter_unparseable_numeric(spark, sf_dir):
    # What an error measured is not a number.
    raw = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.col("value").cast("string")
    )
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("v"))
    return keep_parseable(rows, ["v"], ["event_id"])


@query(
    "filter_prefix",
    "SELECT c_custkey, regexp_extract(c_name, '^Customer#(\\d+)$', 1) AS number FROM customer "
    "WHERE substr(c_name, 1, 9) = 'Customer#' AND regexp_matches(c_name, '^Customer#(\\d+)$')",
)
def filter_prefix(spark, sf_dir):
    lines = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("value"))
    return regex_records(lines, r"^Customer#(\d+)$", ["number"], prefix=(1, "Customer#"))


# --- text ----------------------------------------------------------------------


@query("text_clean", "SELECT doc_id, lower(trim(text, chr(10) || chr(9) || ' ')) AS text FROM documents")
def text_clean(spark, sf_dir):
    text = F.lower(strip_text(col("text"))).alias("text")
    return table(spark, sf_dir, "documents").select("doc_id", text)


@query("prefix_strip", "SELECT o_orderkey, trim(substr(o_orderpriority, 3)) AS priority FROM orders")
def prefix_strip(spark, sf_dir):
    priority = strip_text(left_strip_chars(col("o_orderpriority"), 2)).alias("priority")
    return table(spark, sf_dir, "orders").select("o_orderkey", priority)


@query("split_item", "SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS code FROM orders")
def split_item_(spark, sf_dir):
    code = split_item(col("o_orderpriority"), "-", 0).alias("code")
    return table(spark, sf_dir, "orders").select("o_orderkey", code)


@query(
    "join_middle_fields",
    "SELECT doc_id, array_to_string(list_slice(string_split(text, ' '), 2, "
    "len(string_split(text, ' ')) - 1), ' ') AS mid FROM documents",
)
def join_middle_fields(spark, sf_dir):
    mid = join_middle(col("text"), " ").alias("mid")
    return table(spark, sf_dir, "documents").select("doc_id", mid)


def _sql_replaced(text: str, pairs: Sequence[tuple[str, str]]) -> str:
    for pattern, value in pairs:
        text = f"regexp_replace({text}, '{pattern}', {value}, 'g')"
    return text


@query(
    "html_unescape",
    # Text may be cut inside an entity, so the semicolon may be missing.
    "SELECT page_id, "
    + _sql_replaced(
        "html",
        [
            ("&lt;?", "'<'"), ("&gt;?", "'>'"), ("&quot;?", "'\"'"), ("&#39;?", "chr(39)"),
            ("&copy;?", "chr(169)"), ("&middot;?", "chr(183)"), ("&amp;?", "'&'"),
        ],
    )
    + " AS html FROM pages",
)
def html_unescape_(spark, sf_dir):
    html = html_unescape(col("html")).alias("html")
    return table(spark, sf_dir, "pages").select("page_id", html)


HEADLINE = "<(h[1-6])>(.*?)</h[1-6]>"


@query(
    "regex_tag_capture",
    f"SELECT page_id, trim(regexp_extract(html, '{HEADLINE}', 1)) AS label, "
    f"trim(regexp_extract(html, '{HEADLINE}', 2)) AS text FROM pages",
)
def regex_tag_capture(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        tagged(col("html"), HEADLINE, 1).alias("label"),
        tagged(col("html"), HEADLINE, 2).alias("text"),
    )


@query(
    "strip_inline_tag",
    "SELECT page_id, regexp_replace(html, '<a [^>]*>(.*?)</a>', '\\1', 'g') AS html FROM pages",
)
def strip_inline_tag(spark, sf_dir):
    html = drop_inline_tag(col("html"), "<a [^>]*>(.*?)</a>").alias("html")
    return table(spark, sf_dir, "pages").select("page_id", html)


@query(
    "normalize_punct_spacing",
    "SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, "
    "' +', ' ', 'g'), ' ([.,!?;:%)\\]}])', '\\1', 'g'), '([(\\[{]) ', '\\1', 'g'), "
    "' (''(s|m|d|re|ve|ll)\\b)', '\\1', 'g')) AS text FROM documents",
)
def normalize_punct_spacing(spark, sf_dir):
    text = collapse_punctuation(col("text")).alias("text")
    return table(spark, sf_dir, "documents").select("doc_id", text)


def detokenized_sql(text):
    for pattern, replacement in DETOKENIZING:
        groups = replacement.replace("$", "\\")
        text = f"regexp_replace({text}, {sql_text(pattern)}, {sql_text(groups)}, 'g')"
    return text


APART_SQL = r"regexp_replace(text, '([.,!?;:()\"])', ' \1 ', 'g')"


@query("detokenize_text", f"SELECT doc_id, {detokenized_sql(APART_SQL)} AS text FROM documents")
def detokenize_text(spark, sf_dir):
    # Marks are set apart first, as a tokenizer does.
    apart = F.regexp_replace("text", r'([.,!?;:()"])', " $1 ")
    docs = table(spark, sf_dir, "documents").select("doc_id", apart.alias("text"))
    return docs.select("doc_id", detokenize(col("text")).alias("text"))


@query(
    "parse_numeric",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS n, "
    "CASE WHEN event_type <> 'error' THEN user_id END AS k FROM events",
)
def parse_numeric(spark, sf_dir):
    def raw(name):
        error = F.col("event_type") == "error"
        return F.when(error, F.col("event_type")).otherwise(F.col(name).cast("string"))

    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_number(raw("value")).alias("n"),
        parse_number(raw("user_id"), "bigint").alias("k"),
    )


@query(
    "conditional_flag",
    "SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'medium' ELSE 'low' END "
    "AS arousal FROM events",
)
def conditional_flag(spark, sf_dir):
    value = F.col("value")
    arousal = F.when(value > 50, "high").when(value > 10, "medium").otherwise("low")
    return table(spark, sf_dir, "events").select("event_id", arousal.alias("arousal"))


@query(
    "title_case",
    "SELECT user_id, "
    + ", ".join(f"COUNT(*) FILTER (WHERE event_type = '{e}') AS \"{e.capitalize()}\"" for e in EVENT_TYPES)
    + " FROM events GROUP BY user_id",
)
def title_case_(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    wide = pivot_count(events, "event_type", EVENT_TYPES)
    return project(wide, {"user_id": "user_id"} | {title_case(e): e for e in EVENT_TYPES})


@query(
    "row_map_udf",
    "SELECT event_id, event_type = 'click' AS click, event_type = 'view' AS \"view\" FROM events",
)
def row_map_udf(spark, sf_dir):
    def flags(batch):
        kind = batch["event_type"]
        return batch[["event_id"]].assign(click=kind == "click", view=kind == "view")

    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return map_batches(events, flags, "event_id bigint, click boolean, view boolean")


# --- joins, appends --------------------------------------------------------------


@query(
    "join_inner",
    "SELECT l.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d "
    "INNER JOIN labels l ON d.doc_id = l.doc_id",
)
def join_inner(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return join_on(docs, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "join_natural_self",
    "SELECT o_orderkey, o_orderpriority, status FROM (SELECT o_orderkey, o_orderpriority FROM orders) "
    "NATURAL JOIN (SELECT o_orderkey, map_extract(MAP {'F': 'finished', 'O': 'open'}, "
    "o_orderstatus)[1] AS status FROM orders)",
)
def join_natural_self(spark, sf_dir):
    # Each order has its own key, so the self-join gives one row per order.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    status = map_codes(col("o_orderstatus"), {"F": "finished", "O": "open"})
    joined = natural_self_map(orders, "o_orderkey", {"status": status}, as_join=True)
    return joined.select("o_orderkey", "o_orderpriority", "status")


@query(
    "join_full_outer",
    "SELECT a.user_id, a.d, visits, outcomes FROM (SELECT user_id, CAST(ts AS DATE) AS d, "
    "COUNT(*) AS visits FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL) a FULL JOIN "
    "(SELECT user_id, CAST(ts AS DATE) AS d, COUNT(*) AS outcomes FROM events "
    "WHERE event_type NOT IN ('click', 'view') GROUP BY ALL) b ON a.user_id = b.user_id AND a.d = b.d",
)
def join_full_outer(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    visit = F.col("event_type").isin("click", "view")

    def daily(rows, name):
        day = F.col("ts").cast("date").alias("d")
        return rows.groupBy("user_id", day).agg(F.count(F.lit(1)).alias(name))

    left, right = daily(events.filter(visit), "visits"), daily(events.filter(~visit), "outcomes")
    return full_outer_merge(left, right, ["user_id", "d"], coalesce_keys=False)


@query(
    "merge_records_by_key",
    "SELECT COALESCE(d.doc_id, l.doc_id, b.item_id) AS id, COALESCE(b.text, d.text) AS text, "
    "l.quality / 100 AS quality FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id "
    "FULL JOIN benchmark b ON b.item_id = d.doc_id",
)
def merge_records_by_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    scores = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), rescale_percent(col("quality")).alias("quality")
    )
    # A later source: where it has a text, that one counts.
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return merge_by_key([docs, scores, items], "id", {"text": "string", "quality": "double"})


@query(
    "join_positional",
    "SELECT a.doc_id, b.item_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn "
    "FROM documents) a FULL JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) AS rn "
    "FROM benchmark) b USING (rn)",
)
def join_positional(spark, sf_dir):
    left = table(spark, sf_dir, "documents").select("doc_id")
    right = table(spark, sf_dir, "benchmark").select("item_id")
    return positional_join(left, right, left_parquet=True, right_parquet=True)


@query(
    "join_positional_delimited",
    "SELECT a.doc_id, b.item_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn "
    "FROM documents) a FULL JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) AS rn "
    "FROM benchmark) b USING (rn)",
)
def join_positional_delimited(spark, sf_dir):
    base = staging(spark)

    def scan(name, key, files):
        rows = table(spark, sf_dir, name).select(key).repartitionByRange(files, key)
        folder = staged_csv(rows.sortWithinPartitions(key), f"{base}/{name}")
        return read_delimited(spark, folder, f"{key} bigint")

    return positional_join(scan("documents", "doc_id", 6), scan("benchmark", "item_id", 2))


@query(
    "append_by_position",
    "SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents "
    "UNION ALL SELECT CAST(item_id AS VARCHAR), text FROM benchmark",
)
def append_by_position_(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "text"
    )
    return append_by_position(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query(
    "append_by_name",
    "SELECT doc_id AS id, text, lang FROM documents UNION ALL BY NAME SELECT text, page_id AS id, lang "
    "FROM (SELECT url AS text, page_id, 'xx' AS lang FROM pages)",
)
def append_by_name_(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    pages = table(spark, sf_dir, "pages").select(
        F.col("url").alias("text"), F.col("page_id").alias("id"), F.lit("xx").alias("lang")
    )
    return append_by_name(docs, pages)


@query(
    "append_heterogeneous",
    "SELECT text, lang AS label FROM documents UNION ALL SELECT text, role AS label FROM conversations",
)
def append_heterogeneous(spark, sf_dir):
    docs = project(table(spark, sf_dir, "documents"), {"text": "text", "label": "lang"})
    turns = project(table(spark, sf_dir, "conversations"), {"label": "role", "text": "text"})
    return append_by_name(docs, turns)


@query("order_by_key", "SELECT doc_id, lang FROM documents ORDER BY doc_id")
def order_by_key(spark, sf_dir):
    return ordered(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"])


@query(
    "registry_sorted_distinct",
    "SELECT source, min(CASE WHEN source = 'src0' THEN 0 ELSE 1 END) AS pin FROM documents "
    "GROUP BY source ORDER BY pin, source",
)
def registry_sorted_distinct(spark, sf_dir):
    return sorted_registry(table(spark, sf_dir, "documents"), "source", pinned="src0")


# --- reshape ----------------------------------------------------------------------


@query(
    "pivot_count",
    f"FROM (PIVOT (SELECT user_id, event_type FROM events) ON event_type IN {EVENTS_IN})",
)
def pivot_count_(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    return pivot_count(events, "event_type", EVENT_TYPES)


@query(
    "pivot_presence",
    "FROM (PIVOT (SELECT user_id, CAST(ts AS DATE) AS d, event_type FROM events) "
    f"ON event_type IN {EVENTS_IN} USING arbitrary(true))",
)
def pivot_presence_(spark, sf_dir):
    day = F.col("ts").cast("date").alias("d")
    events = table(spark, sf_dir, "events").select("user_id", day, "event_type")
    return pivot_presence(events, "event_type", EVENT_TYPES)


@query(
    "pivot_bool_and",
    "FROM (PIVOT (SELECT conv_id, role FROM conversations) ON role IN ('assistant', 'system', 'user') "
    "USING BOOL_AND(true))",
)
def pivot_bool_and(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "role")
    return pivot_presence(turns, "role", ("assistant", "system", "user"))


@query(
    "pivot_sum",
    "SELECT user_id, " + sql_names(EVENT_TYPES, "CAST({q} AS BIGINT) AS {q}") + " FROM (PIVOT "
    "(SELECT user_id, event_type, CAST(value > 5 AS INTEGER) AS v FROM events) "
    "ON event_type IN ('click', 'error', 'purchase', 'signup', 'view') USING sum(v))",
)
def pivot_sum_(spark, sf_dir):
    high = (F.col("value") > 5).cast("int").alias("v")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", high)
    return pivot_sum(events, "event_type", EVENT_TYPES, "v")


@query(
    "pivot_mean",
    "FROM (PIVOT (SELECT l_suppkey, l_returnflag, l_quantity FROM lineitem) "
    "ON l_returnflag IN ('A', 'N', 'R') USING mean(l_quantity))",
)
def pivot_mean_(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    return pivot_mean(lines, "l_returnflag", ("A", "N", "R"), "l_quantity")


@query(
    "pivot_any_value",
    "FROM (PIVOT (SELECT doc_id, 'quality' AS k, CAST(quality AS BOOLEAN) AS v FROM labels UNION ALL "
    "SELECT doc_id, 'toxic', CAST(NULLIF(toxic, 0) AS BOOLEAN) FROM labels) "
    "ON k IN ('quality', 'toxic') USING ANY_VALUE(v))",
)
def pivot_any_value_(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.explode(
            F.create_map(
                F.lit("quality"),
                as_flag(col("quality")),
                F.lit("toxic"),
                as_flag(F.nullif(col("toxic"), F.lit(0))),
            )
        ).alias("k", "v"),
    )
    return pivot_any_value(labels, "k", ("quality", "toxic"), "v")


@query(
    "unpivot_drop_nulls",
    "UNPIVOT (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)) "
    "ON quality, toxic INTO NAME emotion VALUE label",
)
def unpivot_drop_nulls(spark, sf_dir):
    return unpivot(docs_with_labels(spark, sf_dir), ["quality", "toxic"], "emotion", "label")


@query(
    "unpivot_merge_pivot",
    "FROM (PIVOT (SELECT text, 'quality' AS emotion, quality AS v FROM documents LEFT JOIN labels "
    "USING (doc_id) WHERE quality IS NOT NULL UNION ALL SELECT text, 'toxic', toxic FROM documents "
    "LEFT JOIN labels USING (doc_id) WHERE toxic IS NOT NULL UNION ALL SELECT text, 'n_chars', "
    "n_chars FROM documents) ON emotion IN ('quality', 'toxic', 'n_chars') USING max(v))",
)
def unpivot_merge_pivot(spark, sf_dir):
    rows = docs_with_labels(spark, sf_dir, "text", "n_chars")
    names = ("quality", "toxic", "n_chars")
    long = [
        unpivot(
            rows.select("text", col(n).cast("bigint").alias(n)), [n], "emotion", "v", keep=["text"]
        )
        for n in names
    ]
    return long_to_wide(long, pivot_any_value, "emotion", names, "v")


@query(
    "pivot_dedup",
    "SELECT text, de, en, es, fr FROM (PIVOT (SELECT text, lang FROM documents) "
    "ON lang IN ('de', 'en', 'es', 'fr'))",
)
def pivot_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return pivot_count(docs, "lang", ("de", "en", "es", "fr"))


@query(
    "pivot_flag",
    "SELECT user_id, " + sql_names(EVENT_TYPES, "CAST({q} AS BOOLEAN) AS {q}") + " FROM (PIVOT "
    f"(SELECT user_id, event_type FROM events) ON event_type IN {sql_in(EVENT_TYPES)})",
)
def pivot_flag_(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return pivot_flag(events.select("user_id", "event_type"), "event_type", EVENT_TYPES)


# --- grouping ----------------------------------------------------------------------


DOC_LABELS_SQL = "SELECT text, source, doc_id, l.quality FROM documents LEFT JOIN labels l USING (doc_id)"


@query(
    "dedup_merge_by_text",
    sql_gathered(
        DOC_LABELS_SQL,
        "text",
        "doc_id",
        {"ids": "doc_id"},
        {"n_quality": "COUNT(quality)", "quality": "MEAN(quality)"},
        ITEMS_PER_PART,
    ),
)
def dedup_merge_by_text(spark, sf_dir):
    return gather_lists(
        docs_with_labels(spark, sf_dir, "text"),
        keys=["text"],
        lists={"ids": "doc_id"},
        order_by=["doc_id"],
        aggs=[F.count("quality").alias("n_quality"), F.avg("quality").alias("quality")],
    )


def by_source(spark, sf_dir, **options):
    return gather_lists(
        docs_with_labels(spark, sf_dir, "source"),
        keys=["source"],
        lists={"quality": "quality"},
        order_by=["doc_id"],
        aggs=[F.count("quality").alias("n_quality")],
        **options,
    )


def by_source_sql(items):
    lists, aggs = {"quality": "quality"}, {"n_quality": "COUNT(quality)"}
    return sql_gathered(DOC_LABELS_SQL, "source", "doc_id", lists, aggs, items)


@query("collect_nullable_arrays", by_source_sql(ITEMS_PER_PART))
def collect_nullable_arrays(spark, sf_dir):
    return by_source(spark, sf_dir)


@query("collect_arrays_in_parts", by_source_sql(20))
def collect_arrays_in_parts(spark, sf_dir):
    # Parts and ranges small enough that every source has several of both.
    return by_source(spark, sf_dir, items_per_part=20, range_rows=30)


@query(
    "count_non_null",
    "SELECT lang, COUNT(l.quality) AS quality, COUNT(l.toxic) AS toxic FROM documents "
    "LEFT JOIN labels l USING (doc_id) GROUP BY lang",
)
def count_non_null_(spark, sf_dir):
    rows = docs_with_labels(spark, sf_dir, "lang")
    return count_non_null(rows, ["lang"], ["quality", "toxic"])


@query(
    "mean_by_group",
    "SELECT lang, MEAN(l.quality) AS quality, MEAN(n_chars) AS n_chars FROM documents "
    "LEFT JOIN labels l USING (doc_id) GROUP BY lang",
)
def mean_by_group(spark, sf_dir):
    return means(docs_with_labels(spark, sf_dir, "lang", "n_chars"), ["lang"], ["quality", "n_chars"])


# --- labels that are not known beforehand ------------------------------------------


def as_text(entries):
    """A map as text, for comparison: its entries in the order they have."""
    return F.array_join(
        F.transform(F.map_entries(entries), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
    )


@query(
    "label_summary",
    "SELECT lang, source AS label, COUNT(*) AS n_rows FROM documents WHERE source IS NOT NULL GROUP BY ALL",
)
def label_summary_(spark, sf_dir):
    """Summaries of two halves, merged per language."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", (F.col("n_chars") % 2).alias("half"))
    parts = label_summary(docs, "source", by=["lang", "half"])
    return summarised_labels(merge_summaries(parts, by=["lang"]), by=["lang"])


OPEN_SQL = (
    "WITH n AS (SELECT user_id, event_type, {cell} AS v FROM events GROUP BY ALL) SELECT user_id, "
    "{click} AS click, {view} AS view, COALESCE(string_agg(event_type || '=' || CAST(v AS VARCHAR), ',' "
    "ORDER BY event_type) FILTER (WHERE event_type NOT IN ('click', 'view')), '') AS other FROM n GROUP BY user_id"
)


@query(
    "pivot_open_count",
    OPEN_SQL.format(
        cell="COUNT(*)",
        click="COALESCE(CAST(SUM(v) FILTER (WHERE event_type = 'click') AS BIGINT), 0)",
        view="COALESCE(CAST(SUM(v) FILTER (WHERE event_type = 'view') AS BIGINT), 0)",
    ),
)
def pivot_open_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    wide = pivot_open(events, "event_type", labels=("click", "view"))
    return wide.withColumn("other", as_text(F.col("other")))


@query(
    "pivot_open_max",
    OPEN_SQL.format(
        cell="MAX(event_id)",
        click="MAX(v) FILTER (WHERE event_type = 'click')",
        view="MAX(v) FILTER (WHERE event_type = 'view')",
    ),
)
def pivot_open_max(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    wide = pivot_open(events, "event_type", "max", "event_id", labels=("click", "view"))
    return wide.withColumn("other", as_text(F.col("other")))

"""Corpus plans, fed with raw-shaped frames made from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..columns import col
from ..operators.grouping import ITEMS_PER_PART
from ..plans import get_corpus
from ..plans.direct import GO_LABELS, LIAR_SCORES, PLUTCHIK, SEMEVAL_LABELS, USVSTHEM_LABELS
from ..plans.longwide import HURRICANES8_LABELS, INTENSITY_LABELS
from ..plans.pivoted import (
    CROWDFLOWER_LABELS,
    GOODNEWS_LABELS,
    ISEAR_LABELS,
    STIMULUS_LABELS,
    STOCK_LABELS,
    TEC_LABELS,
)
from ..plans.joined import WASSA_LABELS
from ..plans.records import AFFECTIVE_LABELS, REN_LABELS, XED_CODES
from ..plans.votes import (
    AROUSAL_CODES,
    ELECTORAL_LABELS,
    HURRICANES24_LABELS,
    TALES_CODES,
    VALENCE_CODES,
)
from ..functions import title_case
from .base import (
    USER_TEXT_SQL,
    pick,
    query,
    sql_gathered,
    sql_in,
    sql_names,
    sql_pick,
    sql_text,
    table,
    user_text,
)


def flags(labels, hit):
    return [hit(i).alias(n) for i, n in enumerate(labels)]


def docs_frame(spark, sf_dir):
    return table(spark, sf_dir, "documents")


# --- direct projections ---------------------------------------------------------


@query(
    "pipe_fbvalencearousal",
    "SELECT c_name AS text, (c_acctbal + c_custkey) / 2.0 AS valence, "
    "(c_acctbal + c_nationkey) / 2.0 AS arousal FROM customer",
)
def pipe_fbvalencearousal(spark, sf_dir):
    posts = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("Anonymized Message"),
        F.col("c_acctbal").alias("Valence1"),
        F.col("c_custkey").cast("double").alias("Valence2"),
        F.col("c_acctbal").alias("Arousal1"),
        F.col("c_nationkey").cast("double").alias("Arousal2"),
    )
    return get_corpus("FBValenceArousal").build({"posts": posts})


@query(
    "pipe_goemotions",
    f"SELECT {USER_TEXT_SQL} AS text, CAST(event_id AS VARCHAR) AS id, "
    "CAST(user_id AS VARCHAR) AS author, event_type AS subreddit, "
    "CAST(event_id // 10 AS VARCHAR) AS link_id, CAST(event_id // 20 AS VARCHAR) AS parent_id, "
    "CAST(value AS FLOAT) AS created_utc, user_id AS rater_id, value > 300 AS example_very_unclear, "
    + sql_names(GO_LABELS, "event_id % 28 = {i} AS {q}")
    + " FROM events",
)
def pipe_goemotions(spark, sf_dir):
    event = F.col("event_id")
    ratings = table(spark, sf_dir, "events").select(
        user_text().alias("text"),
        event.cast("string").alias("id"),
        F.col("user_id").cast("string").alias("author"),
        F.col("event_type").alias("subreddit"),
        F.expr("event_id div 10").cast("string").alias("link_id"),
        F.expr("event_id div 20").cast("string").alias("parent_id"),
        F.col("value").cast("float").alias("created_utc"),
        F.col("user_id").alias("rater_id"),
        (F.col("value") > 300).cast("int").cast("string").alias("example_very_unclear"),
        *flags(GO_LABELS, lambda i: (event % 28 == i).cast("int").cast("string")),
    )
    return get_corpus("GoEmotions").build({"ratings": ratings})


@query(
    "pipe_semeval2018classification",
    "SELECT CAST(doc_id AS VARCHAR) AS id, text, "
    + ", ".join(f"doc_id % {k} <> 0 AS {n}" for k, n in enumerate(SEMEVAL_LABELS, start=2))
    + " FROM documents",
)
def pipe_semeval2018classification(spark, sf_dir):
    tweets = docs_frame(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("ID"),
        F.col("text").alias("Tweet"),
        *flags(SEMEVAL_LABELS, lambda i: (F.col("doc_id") % (i + 2)).cast("int")),
    )
    return get_corpus("Semeval2018Classification").build({"tweets": tweets})


LIAR_SCORE_SQL = (
    "n_chars / 1000 AS sentiment_score, (n_chars % 11) / 10 AS anger, (n_chars % 7) / 10 AS fear, "
    "(n_chars % 5) / 10 AS joy, (n_chars % 3) / 10 AS disgust, (n_chars % 13) / 10 AS sad"
)


@query(
    "pipe_sentimentalliar",
    "SELECT doc_id AS ID, text AS statement, source AS subject, lang AS speaker, NULL::VARCHAR AS "
    f"context, 'NEG' AS sentiment, {LIAR_SCORE_SQL} FROM documents UNION ALL SELECT conv_id, text, "
    "role, 'turn', 'speech', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM conversations",
)
def pipe_sentimentalliar(spark, sf_dir):
    n_chars = F.col("n_chars")
    divisors = dict(zip(LIAR_SCORES[1:], (11, 7, 5, 3, 13), strict=True))
    scored = docs_frame(spark, sf_dir).select(
        F.col("doc_id").alias("ID"),
        F.col("text").alias("statement"),
        F.col("source").alias("subject"),
        F.col("lang").alias("speaker"),
        F.lit("NEG").alias("sentiment"),
        (n_chars / 1000).alias("sentiment_score"),
        *[((n_chars % k) / 10).alias(n) for n, k in divisors.items()],
    )
    spoken = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("ID"),
        F.col("text").alias("statement"),
        F.col("role").alias("subject"),
        F.lit("turn").alias("speaker"),
        F.lit("speech").alias("context"),
    )
    statements = scored.unionByName(spoken, allowMissingColumns=True)
    return get_corpus("SentimentalLIAR").build({"statements": statements})


@query(
    "pipe_ssec",
    "SELECT text, "
    + ", ".join(f"doc_id % {k} = 0 AS {n}" for k, n in enumerate(PLUTCHIK, start=2))
    + " FROM documents",
)
def pipe_ssec(spark, sf_dir):
    marks = flags(PLUTCHIK, lambda i: F.when(F.col("doc_id") % (i + 2) == 0, "marked"))
    tweets = docs_frame(spark, sf_dir).select(*marks, "text")
    return get_corpus("SSEC").build({"tweets": tweets})


def usvsthem_raws(spark, sf_dir):
    names = [*USVSTHEM_LABELS[:-1], "emotions_neutral"]
    comments = docs_frame(spark, sf_dir).select(
        F.col("lang").alias("bias"),
        F.col("source").alias("group"),
        (F.col("n_chars") / 1000).alias("usVSthem_scale"),
        F.col("text").alias("body"),
        *flags(names, lambda i: (F.col("doc_id") % (i + 2) == 0).cast("int")),
    )
    return {"comments": comments}


@query(
    "pipe_usvsthem",
    'SELECT lang AS bias, source AS "group", n_chars / 1000 AS "usVSthem_scale", text, '
    + ", ".join(f"CAST(doc_id % {k} = 0 AS INTEGER) AS {n}" for k, n in enumerate(USVSTHEM_LABELS, 2))
    + " FROM documents",
)
def pipe_usvsthem(spark, sf_dir):
    return get_corpus("UsVsThem").build(usvsthem_raws(spark, sf_dir))


# --- pivots ---------------------------------------------------------------------


def crowdflower_raws(spark, sf_dir):
    tweets = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("tweet_id"),
        pick(CROWDFLOWER_LABELS, F.col("event_id") % 13).alias("sentiment"),
        F.col("props").alias("author"),
        user_text().alias("content"),
    )
    return {"tweets": tweets}


@query(
    "pipe_crowdflower",
    f"FROM (PIVOT (SELECT CAST(user_id AS VARCHAR) AS tweet_id, {USER_TEXT_SQL} AS text, "
    f"{sql_pick(CROWDFLOWER_LABELS, 'event_id % 13')} AS sentiment FROM events) "
    f"ON sentiment IN {sql_in(CROWDFLOWER_LABELS)})",
)
def pipe_crowdflower(spark, sf_dir):
    return get_corpus("CrowdFlower").build(crowdflower_raws(spark, sf_dir))


STIMULUS_SQL = sql_names(STIMULUS_LABELS, "COUNT(*) FILTER (WHERE emotion = {t}) > 0 AS {q}")


@query(
    "pipe_emotionstimulus",
    f"SELECT text, {STIMULUS_SQL} FROM (SELECT {USER_TEXT_SQL} || ', really!' AS text, "
    f"{sql_pick(STIMULUS_LABELS, 'event_id % 7')} AS emotion FROM events UNION ALL "
    "SELECT 'order (' || o_orderpriority || ') of ' || CAST(o_custkey AS VARCHAR) || ' & co.', "
    f"{sql_pick(STIMULUS_LABELS, 'o_orderkey % 7')} FROM orders) GROUP BY text",
)
def pipe_emotionstimulus(spark, sf_dir):
    tag = pick(STIMULUS_LABELS, F.col("event_id") % 7)
    caused = table(spark, sf_dir, "events").select(
        F.format_string(
            "<%s>user  %d <cause>%s<\\cause> , really !<\\%s> ", tag, "user_id", "event_type", tag
        ).alias("value")
    )
    tag = pick(STIMULUS_LABELS, F.col("o_orderkey") % 7)
    plain = table(spark, sf_dir, "orders").select(
        F.format_string(
            # The cause lies outside the emotion's tags.
            "<%s>order ( %s ) of %d &amp; co .<\\%s> because <cause>it rained<\\cause> .",
            tag,
            "o_orderpriority",
            "o_custkey",
            tag,
        ).alias("value")
    )
    raws = {"with_cause": caused, "without_cause": plain}
    return get_corpus("EmotionStimulus").build(raws)


@query(
    "pipe_goodnewseveryone",
    "SELECT id, source, text, intensity, "
    + sql_names(GOODNEWS_LABELS, "CAST({q} AS BOOLEAN) AS {q}")
    + f" FROM (PIVOT (SELECT user_id AS id, event_type AS source, {USER_TEXT_SQL} AS text, "
    "CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS intensity, "
    f"{sql_pick(GOODNEWS_LABELS, 'event_id % 15')} AS emotion FROM events) "
    f"ON emotion IN {sql_in(GOODNEWS_LABELS)})",
)
def pipe_goodnewseveryone(spark, sf_dir):
    headlines = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("source"),
        user_text().alias("headline"),
        pick(GOODNEWS_LABELS, F.col("event_id") % 15).alias("dominant_emotion"),
        F.when(F.col("value") > 50, "high").otherwise("low").alias("intensity"),
    )
    return get_corpus("GoodNewsEveryone").build({"headlines": headlines})


@query(
    "pipe_isear",
    "SELECT id, subject_id, text, "
    + sql_names(ISEAR_LABELS, "IFNULL({q}, FALSE) AS {q}")
    + f" FROM (PIVOT (SELECT event_id AS id, user_id AS subject_id, {USER_TEXT_SQL} AS text, "
    "map_extract(MAP {1: 'joy', 2: 'fear', 3: 'anger', 4: 'sadness', 5: 'disgust', 6: 'shame', "
    "7: 'guilt'}, event_id % 9)[1] AS emotion FROM events) "
    f"ON emotion IN {sql_in(ISEAR_LABELS)} USING arbitrary(true))",
)
def pipe_isear(spark, sf_dir):
    answers = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("MYKEY"),
        F.col("user_id").alias("ID"),
        user_text().alias("SIT"),
        (F.col("event_id") % 9).cast("string").alias("EMOT"),
    )
    return get_corpus("ISEAR").build({"answers": answers})


@query(
    "pipe_stockemotions",
    "SELECT id, ticker, text, "
    + sql_names(STOCK_LABELS, "CAST({q} AS BOOLEAN) AS {q}")
    + f", senti_label AS sentiment FROM (PIVOT (SELECT user_id AS id, event_type AS ticker, "
    f"{USER_TEXT_SQL} AS text, CAST(ts AS DATE) AS d, "
    "CASE WHEN value > 20 THEN 'bullish' ELSE 'bearish' END AS senti_label, "
    f"{sql_pick(STOCK_LABELS, 'event_id % 12')} AS emotion FROM events) "
    f"ON emotion IN {sql_in(STOCK_LABELS)})",
)
def pipe_stockemotions(spark, sf_dir):
    comments = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("ticker"),
        pick(STOCK_LABELS, F.col("event_id") % 12).alias("emo_label"),
        F.when(F.col("value") > 20, "bullish").otherwise("bearish").alias("senti_label"),
        user_text().alias("original"),
    )
    return get_corpus("StockEmotions").build({"comments": comments})


TEC_FLAGS_SQL = sql_names(TEC_LABELS, "bool_or(emotion = {t}) AS {q}")
TEC_SQL = (
    f"SELECT id, text, {TEC_FLAGS_SQL} FROM (SELECT l_orderkey AS id, 'tom & ' || l_linestatus || "
    "chr(9) || CAST(l_linenumber AS VARCHAR) AS text, map_extract(MAP {'A': 'anger', 'N': 'joy', "
    "'R': 'sadness'}, l_returnflag)[1] AS emotion FROM lineitem) GROUP BY id, text"
)


def tec_raws(spark, sf_dir):
    emotion = (
        F.when(F.col("l_returnflag") == "A", "anger")
        .when(F.col("l_returnflag") == "N", "joy")
        .otherwise("sadness")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(
            F.col("l_orderkey").cast("string"),
            F.lit(":\t tom &amp; "),
            F.col("l_linestatus"),
            F.lit("\t"),
            F.col("l_linenumber").cast("string"),
            F.lit(" \t:: "),
            emotion,
        ).alias("value")
    )
    return {"lines": lines}


@query("pipe_tec", TEC_SQL)
def pipe_tec(spark, sf_dir):
    return get_corpus("TEC").build(tec_raws(spark, sf_dir))


# --- long to wide ---------------------------------------------------------------


@query(
    "pipe_canceremo",
    "SELECT text, "
    + sql_names(PLUTCHIK, "bool_or(v) FILTER (WHERE emotion = {t}) AS {q}")
    + " FROM ("
    + " UNION ALL ".join(
        f"SELECT text, '{n}' AS emotion, CAST(length(text) % {i + 2} AS BOOLEAN) AS v "
        f"FROM documents WHERE n_chars > {(i + 1) * 100}"
        for i, n in enumerate(PLUTCHIK)
    )
    + ") GROUP BY text",
)
def pipe_canceremo(spark, sf_dir):
    # Each label's file holds every text; a short text has no answer there.
    def answers(i, label):
        answered = F.when(F.col("n_chars") > (i + 1) * 100, F.length("text") % (i + 2))
        return docs_frame(spark, sf_dir).select(
            F.col("text").alias("Sentence"), answered.alias(title_case(label))
        )

    raws = {label: answers(i, label) for i, label in enumerate(PLUTCHIK)}
    return get_corpus("CancerEmo").build(raws)


@query(
    "pipe_hurricanes8",
    "SELECT text, "
    + sql_names(HURRICANES8_LABELS, "bool_or(emotion = {t} AND v) AS {q}")
    + " FROM ("
    + " UNION ALL ".join(
        f"SELECT {USER_TEXT_SQL} AS text, '{n}' AS emotion, value > {(i + 1) * 40} AS v FROM events"
        for i, n in enumerate(HURRICANES8_LABELS)
    )
    + ") GROUP BY text",
)
def pipe_hurricanes8(spark, sf_dir):
    def answers(i, label):
        chosen = (F.col("value") > (i + 1) * 40).cast("int").alias(label)
        return table(spark, sf_dir, "events").select(user_text().alias("text"), chosen)

    raws = {label: answers(i, label) for i, label in enumerate(HURRICANES8_LABELS)}
    return get_corpus("Hurricanes8").build(raws)


@query(
    "pipe_emoint",
    sql_gathered(
        "FROM (PIVOT (SELECT l_orderkey AS id, 'part ' || CAST(l_partkey AS VARCHAR) AS text, "
        f"{sql_pick(INTENSITY_LABELS, 'l_linenumber % 4')} AS emotion, l_quantity AS intensity "
        f"FROM lineitem) ON emotion IN {sql_in(INTENSITY_LABELS)} USING sum(intensity))",
        "text",
        "id",
        {"ids": "id"},
        {n: f'MEAN("{n}")' for n in INTENSITY_LABELS},
        ITEMS_PER_PART,
    ),
)
def pipe_emoint(spark, sf_dir):
    ratings = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("text"),
        pick(INTENSITY_LABELS, F.col("l_linenumber") % 4).alias("emotion"),
        F.col("l_quantity").alias("intensity"),
    )
    return get_corpus("EmoInt").build({"ratings": ratings})


@query(
    "pipe_semeval2018intensity",
    "WITH i AS (FROM (PIVOT (SELECT CAST(l_orderkey AS VARCHAR) AS id, "
    "'order ' || CAST(l_orderkey AS VARCHAR) AS text, "
    f"{sql_pick(INTENSITY_LABELS, 'l_linenumber % 4')} AS emotion, l_quantity AS v FROM lineitem) "
    f"ON emotion IN {sql_in(INTENSITY_LABELS)} USING MEAN(v))), "
    "v AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'order ' || CAST(o_orderkey AS VARCHAR) AS text, "
    "MEAN(o_totalprice) AS valence FROM orders GROUP BY ALL) "
    "SELECT COALESCE(i.id, v.id) AS id, COALESCE(i.text, v.text) AS text, valence, "
    + sql_names(INTENSITY_LABELS)
    + " FROM i FULL JOIN v ON i.id = v.id AND i.text = v.text",
)
def pipe_semeval2018intensity(spark, sf_dir):
    def raw(name, key, dimension, score):
        return table(spark, sf_dir, name).select(
            F.col(key).cast("string").alias("ID"),
            F.concat(F.lit("order "), F.col(key).cast("string")).alias("Tweet"),
            dimension.alias("Affect Dimension"),
            F.col(score).alias("Intensity Score"),
        )

    dimension = pick(INTENSITY_LABELS, F.col("l_linenumber") % 4)
    raws = {
        "intensity": raw("lineitem", "l_orderkey", dimension, "l_quantity"),
        "valence": raw("orders", "o_orderkey", F.lit("valence"), "o_totalprice"),
    }
    return get_corpus("Semeval2018Intensity").build(raws)


# --- joins ----------------------------------------------------------------------


def emobank_raws(spark, sf_dir):
    doc = F.col("doc_id").cast("string").alias("id")
    data = docs_frame(spark, sf_dir).select(
        doc,
        F.when(F.col("lang") == "en", "test").otherwise("train").alias("split"),
        (F.col("n_chars") / 100).alias("V"),
        (F.col("doc_id") % 5).alias("A"),
        (F.col("doc_id") % 3).alias("D"),
        "text",
    )
    meta = table(spark, sf_dir, "labels").select(
        doc,
        F.format_string("doc%d", F.col("doc_id") % 50).alias("document"),
        F.format_string("q%d", "quality").alias("category"),
        F.format_string("t%d", "toxic").alias("subcategory"),
    )
    return {"data": data, "meta": meta}


@query(
    "pipe_emobank",
    "SELECT CAST(d.doc_id AS VARCHAR) AS id, 'doc' || CAST(l.doc_id % 50 AS VARCHAR) AS document, "
    "'q' || CAST(quality AS VARCHAR) AS category, 't' || CAST(toxic AS VARCHAR) AS subcategory, "
    "CASE WHEN lang = 'en' THEN 'test' ELSE 'train' END AS split, n_chars / 100 AS V, "
    "d.doc_id % 5 AS A, d.doc_id % 3 AS D, text FROM documents d JOIN labels l USING (doc_id)",
)
def pipe_emobank(spark, sf_dir):
    return get_corpus("EmoBank").build(emobank_raws(spark, sf_dir))


@query(
    "pipe_wassa22",
    "SELECT id, article_id, text, empathy, distress, "
    + sql_names(WASSA_LABELS, "IFNULL({q}, false) AS {q}")
    + " FROM (PIVOT (SELECT CAST(doc_id AS VARCHAR) AS id, source AS article_id, text, "
    f"{sql_pick(WASSA_LABELS, 'doc_id % 7')} AS emotion, CAST(n_chars % 7 AS INTEGER) AS empathy, "
    "CAST(n_chars % 5 AS INTEGER) AS distress FROM documents UNION ALL "
    "SELECT f.id, f.role, f.text, l.emotion, l.quality, l.toxic FROM (SELECT CAST(conv_id AS VARCHAR) "
    "|| '.' || CAST(turn AS VARCHAR) AS id, role, text, row_number() OVER (ORDER BY conv_id, turn) "
    "AS rn FROM conversations) f FULL JOIN (SELECT quality, toxic, "
    f"{sql_pick(WASSA_LABELS, 'doc_id % 7')} AS emotion, row_number() OVER (ORDER BY doc_id) AS rn "
    f"FROM labels) l USING (rn)) ON emotion IN {sql_in(WASSA_LABELS)} USING BOOL_AND(true))",
)
def pipe_wassa22(spark, sf_dir):
    train = docs_frame(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("message_id"),
        F.col("source").alias("article_id"),
        F.col("text").alias("essay"),
        pick(WASSA_LABELS, F.col("doc_id") % 7).alias("emotion"),
        (F.col("n_chars") % 7).cast("int").alias("empathy"),
        (F.col("n_chars") % 5).cast("int").alias("distress"),
    )
    features = table(spark, sf_dir, "conversations").select(
        F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias(
            "message_id"
        ),
        F.col("role").alias("article_id"),
        F.col("text").alias("essay"),
    )
    labels = table(spark, sf_dir, "labels").select(
        F.col("quality").alias("empathy"),
        F.col("toxic").alias("distress"),
        pick(WASSA_LABELS, F.col("doc_id") % 7).alias("emotion"),
    )
    raws = {"train": train, "dev_features": features, "dev_labels": labels}
    return get_corpus("WASSA22").build(raws, parquet=True)


# --- records --------------------------------------------------------------------


@query(
    "pipe_affectivetext",
    "WITH t AS (SELECT doc_id AS id, text FROM documents), e AS (SELECT doc_id AS id, "
    + sql_names(AFFECTIVE_LABELS, "(doc_id * ({i} + 1)) % 101 AS {q}")
    + " FROM documents), v AS (SELECT doc_id AS id, quality * 100 - toxic * 50 AS valence FROM labels), "
    "t2 AS (SELECT item_id AS id, text FROM benchmark), "
    "e2 AS (SELECT p_partkey AS id, "
    + sql_names(AFFECTIVE_LABELS, "p_size + {i} AS {q}")
    + " FROM part), v2 AS (SELECT s_suppkey AS id, s_nationkey AS valence FROM supplier) "
    "SELECT id, COALESCE(t2.text, t.text) AS text, "
    + sql_names(AFFECTIVE_LABELS, "COALESCE(e2.{q}, e.{q}) / 100 AS {q}")
    + ", COALESCE(v2.valence, v.valence) / 100 AS valence FROM t FULL JOIN e USING (id) "
    "FULL JOIN v USING (id) FULL JOIN t2 USING (id) FULL JOIN e2 USING (id) FULL JOIN v2 USING (id)",
)
def pipe_affectivetext(spark, sf_dir):
    doc, key = F.col("doc_id"), F.col("doc_id").alias("id")
    docs = docs_frame(spark, sf_dir)
    raws = {
        "trial_text": docs.select(key, "text"),
        "trial_emotions": docs.select(key, *flags(AFFECTIVE_LABELS, lambda i: doc * (i + 1) % 101)),
        "trial_valence": table(spark, sf_dir, "labels").select(
            key, (F.col("quality") * 100 - F.col("toxic") * 50).alias("valence")
        ),
        "test_text": table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"),
        "test_emotions": table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("id"), *flags(AFFECTIVE_LABELS, lambda i: F.col("p_size") + i)
        ),
        "test_valence": table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("valence")
        ),
    }
    return get_corpus("AffectiveText").build(raws)


def carer_raws(spark, sf_dir):
    def split(name):
        label = (F.length("text") % 6).cast("int").alias("label")
        return table(spark, sf_dir, name).select("text", label)

    return {
        "train": split("documents"),
        "validation": split("conversations"),
        "test": split("benchmark"),
    }


@query(
    "pipe_carer",
    "SELECT text, length(text) % 6 = 0 AS sadness, length(text) % 6 = 1 AS joy, "
    "length(text) % 6 = 2 AS love, length(text) % 6 = 3 AS anger, length(text) % 6 = 4 AS fear, "
    "length(text) % 6 = 5 AS surprise FROM (SELECT text FROM documents UNION ALL "
    "SELECT text FROM conversations UNION ALL SELECT text FROM benchmark)",
)
def pipe_carer(spark, sf_dir):
    return get_corpus("CARER").build(carer_raws(spark, sf_dir))


@query(
    "pipe_ren20k",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, NULL::VARCHAR AS role, "
    "trim(text, ' ' || chr(10) || chr(9)) AS text, "
    + sql_names(REN_LABELS, "CAST((doc_id * ({i} + 1)) % 100 AS DOUBLE) / 100 AS {q}")
    + " FROM documents WHERE lang <> 'de' UNION ALL SELECT NULL, role, "
    "trim(text, ' ' || chr(10) || chr(9)), "
    + sql_names(REN_LABELS, "CAST(turn + {i} AS DOUBLE) / 100")
    + " FROM conversations",
)
def pipe_ren20k(spark, sf_dir):
    # German documents report a mood that is not a number; their rows go.
    doc = F.col("doc_id")

    def mood(i):
        share = (doc * (i + 1) % 100).cast("string")
        return F.when(F.col("lang") == "de", "n/a").otherwise(share) if i == 0 else share

    first = docs_frame(spark, sf_dir).select(
        F.concat(F.lit(" "), doc.cast("string")).alias("Doc_ID "),
        F.col("text").alias("Content"),
        *[mood(i).alias(f" {title_case(n)}") for i, n in enumerate(REN_LABELS)],
    )
    second = table(spark, sf_dir, "conversations").select(
        *[(F.col("turn") + i).cast("string").alias(n.upper()) for i, n in enumerate(REN_LABELS)],
        F.col("text").alias("CONTENT"),
        F.col("role").alias("Role"),
    )
    return get_corpus("REN20k").build({"part0": first, "part1": second})


XED_LABELS = tuple(XED_CODES.values())


@query(
    "pipe_xed",
    "SELECT text, "
    + sql_names(XED_LABELS, "doc_id % 9 = {i} OR n_chars % 4 = {i} AS {q}")
    + " FROM documents UNION ALL SELECT text, "
    + sql_names(XED_LABELS, "{t} = 'neutral'")
    + " FROM benchmark",
)
def pipe_xed(spark, sf_dir):
    codes = F.concat_ws(
        ", ",
        (F.col("doc_id") % 9 + 1).cast("string"),
        (F.col("n_chars") % 4 + 1).cast("string"),
    )
    raws = {
        "annotated": docs_frame(spark, sf_dir).select("text", codes.alias("labels")),
        "neutral": table(spark, sf_dir, "benchmark").select(F.lit("neutral").alias("label"), "text"),
    }
    return get_corpus("XED").build(raws)


# --- votes ----------------------------------------------------------------------


VALENCE_SQL = sql_pick(["neutral", "negative", "positive"], "{} % 4")
AROUSAL_SQL = sql_pick(["high", "medium", "low"], "{} % 5")


@query(
    "pipe_electoraltweets",
    sql_gathered(
        "SELECT DISTINCT event_id AS id, CAST(value AS FLOAT) AS trust_, "
        f"{USER_TEXT_SQL} AS text, {sql_pick(ELECTORAL_LABELS, 'event_id % 19')} AS emotion, "
        f"{VALENCE_SQL.format('user_id')} AS valence, {AROUSAL_SQL.format('user_id')} AS arousal "
        "FROM events UNION ALL SELECT o_orderkey, CAST(o_totalprice AS FLOAT), "
        "'user ' || CAST(o_custkey AS VARCHAR) || ' click', "
        f"{sql_pick(ELECTORAL_LABELS, 'o_custkey % 19')}, {VALENCE_SQL.format('o_custkey')}, "
        f"{AROUSAL_SQL.format('o_custkey')} FROM orders",
        "text",
        "id, trust_ NULLS FIRST, valence NULLS FIRST, arousal NULLS FIRST",
        {"ids": "id", "annotator_trusts": "trust_", "valence": "valence", "arousal": "arousal"},
        {n: f"COUNT(*) FILTER (WHERE emotion = {sql_text(n)})" for n in ELECTORAL_LABELS},
        ITEMS_PER_PART,
    ),
)
def pipe_electoraltweets(spark, sf_dir):
    valence = [*VALENCE_CODES, "no answer"]
    arousal = [*AROUSAL_CODES, "no answer", "unsure"]

    def batch(name, key, trust, text, emotion, person):
        return table(spark, sf_dir, name).select(
            F.col(key).alias("id"),
            F.col(trust).cast("float").alias("annotator_trust"),
            text.alias("text"),
            pick(ELECTORAL_LABELS, F.col(emotion) % 19).alias("emotion"),
            pick(valence, F.col(person) % 4).alias("valence"),
            pick(arousal, F.col(person) % 5).alias("arousal"),
        )

    ordered = F.concat(F.lit("user "), F.col("o_custkey").cast("string"), F.lit(" click"))
    raws = {
        "Batch1": batch("events", "event_id", "value", user_text(), "event_id", "user_id"),
        "Batch2": batch("orders", "o_orderkey", "o_totalprice", ordered, "o_custkey", "o_custkey"),
    }
    return get_corpus("ElectoralTweets").build(raws)


@query(
    "pipe_hurricanes24",
    f"SELECT event_type AS hurricane, {USER_TEXT_SQL} AS text, "
    + sql_names(
        HURRICANES24_LABELS,
        "CAST(event_id % ({i} + 2) = 0 AS BIGINT) + CAST(user_id % ({i} + 2) = 0 AS BIGINT) AS {q}",
    )
    + " FROM events",
)
def pipe_hurricanes24(spark, sf_dir):
    def ballot(key):
        return F.struct(*flags(HURRICANES24_LABELS, lambda i: F.col(key) % (i + 2) == 0))

    tweets = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("hurricane"),
        user_text().alias("text"),
        F.create_map(F.lit("w1"), ballot("event_id"), F.lit("w2"), ballot("user_id")).alias(
            "annotations"
        ),
    )
    return get_corpus("Hurricanes24").build({"tweets": tweets})


TALES_LABELS = tuple(TALES_CODES.values())


@query(
    "pipe_talesemotions",
    "SELECT source AS author, lang AS story, CAST(doc_id AS VARCHAR) AS sent_id, text, "
    + sql_names(
        TALES_LABELS,
        "CAST(doc_id % 8 = {i} AS INTEGER) + CAST(n_chars % 8 = {i} AS INTEGER) AS {q}",
    )
    + " FROM documents",
)
def pipe_talesemotions(spark, sf_dir):
    codes = list(TALES_CODES)
    first, second = pick(codes, F.col("doc_id") % 8), pick(codes, F.col("n_chars") % 8)
    sentences = docs_frame(spark, sf_dir).select(
        F.col("source").alias("author"),
        F.col("lang").alias("story"),
        F.format_string("%d:x", "doc_id").alias("sent"),
        F.concat_ws(":", first, second).alias("primary"),
        F.lit("N:N").alias("mood"),
        col("text"),
    )
    return get_corpus("TalesEmotions").build({"sentences": sentences})

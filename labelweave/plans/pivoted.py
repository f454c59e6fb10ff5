"""Corpora with one label per row that become one column per label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, cols
from ..functions import (
    detokenize,
    drop_inline_tag,
    html_unescape,
    join_middle,
    left_strip_chars,
    map_codes,
    null_to,
    parse_number,
    project,
    split_item,
    strip_text,
)
from ..functions.text import last_item, right_strip_chars
from ..operators import append_by_name, ordered, pivot_count, pivot_flag, pivot_presence
from ..sources import Dialect, read_delimited, read_header_cast, read_lines, regex_records
from .base import Corpus, CorpusInfo, Raws, register

# --- CrowdFlower --------------------------------------------------------------

# Label columns.
CROWDFLOWER_LABELS = (
    "anger", "boredom", "empty", "enthusiasm", "fun", "happiness", "hate", "love", "neutral",
    "relief", "sadness", "surprise", "worry",
)
CROWDFLOWER_SCHEMA = "tweet_id string, sentiment string, author string, content string"


def _crowdflower_read(spark: SparkSession, folder: str) -> Raws:
    return {"tweets": read_delimited(spark, f"{folder}/data.csv", CROWDFLOWER_SCHEMA)}


def _crowdflower_build(raws: Raws) -> DataFrame:
    # The author is left out before the pivot: it would be a grouping column.
    tweets = project(
        raws["tweets"], {"tweet_id": "tweet_id", "sentiment": "sentiment", "text": "content"}
    )
    return pivot_count(tweets, "sentiment", CROWDFLOWER_LABELS)


register(
    Corpus(
        "CrowdFlower",
        CorpusInfo(
            description="Tweets sorted into 13 emotion classes; cells count the annotations.",
            citation="",
            homepage="",
            license="",
            labels=CROWDFLOWER_LABELS,
            multilabel=False,
            continuous=False,
            system="Hashtags of the posts",
            domain="Twitter posts",
        ),
        _crowdflower_read,
        _crowdflower_build,
    )
)

# --- EmotionStimulus ----------------------------------------------------------

# Label columns, and the two patterns of an annotated line.
STIMULUS_LABELS = ("anger", "disgust", "fear", "happy", "sad", "shame", "surprise")
STIMULUS_LINE = r"^\s*<(.*?)>(.*)<\\[^br][A-Za-z0-9]+>"
STIMULUS_CAUSE = r"<cause>(.*)<\\cause>"


def _stimulus_read(spark: SparkSession, folder: str) -> Raws:
    return {
        "with_cause": read_lines(spark, f"{folder}/Emotion Cause.txt"),
        "without_cause": read_lines(spark, f"{folder}/No Cause.txt"),
    }


def _stimulus_build(raws: Raws, strict: bool = False) -> DataFrame:
    """Cause tags go first, as they may lie outside the emotion's; then each line is
    matched once and the parts are cut from the match."""
    lines = append_by_name(
        *[raws[n].select("value") for n in ("with_cause", "without_cause")]
    ).select(drop_inline_tag(col("value"), STIMULUS_CAUSE).alias("value"))
    match = F.regexp_extract(col("value"), STIMULUS_LINE, 0)
    if strict:
        error = F.raise_error(F.concat(F.lit("line does not match: "), col("value")))
        match = F.when(col("value").isNotNull() & (match == ""), error).otherwise(match)
    matched = lines.select(match.alias("match")).filter(F.col("match") != "")
    # The emotion ends at the first ">", the text at the last closing tag.
    head = matched.select("match", F.substring_index("match", ">", 1).alias("head"))
    body = head.select(
        F.substring_index("head", "<", -1).alias("emotion"),
        F.substr("match", F.char_length("head") + 2).alias("rest"),
    )
    closing = F.char_length(F.substring_index("rest", "<\\", -1)) + 2
    spaced = body.select(
        detokenize(F.left("rest", F.char_length("rest") - closing)).alias("text"),
        strip_text(col("emotion")).alias("emotion"),
    )
    plain = spaced.select(html_unescape(col("text")).alias("text"), "emotion")
    records = plain.select(strip_text(col("text")).alias("text"), "emotion")
    return pivot_flag(records, "emotion", STIMULUS_LABELS)


register(
    Corpus(
        "EmotionStimulus",
        CorpusInfo(
            description="Sentences with an emotion-bearing word, some with its cause marked.",
            citation="Ghazi et al. 2015, Detecting emotion stimuli in emotion-bearing sentences",
            homepage="https://www.eecs.uottawa.ca/~diana/resources/emotion_stimulus_data/",
            license="",
            labels=STIMULUS_LABELS,
            multilabel=False,
            continuous=False,
            system="Ekman's basic emotions and shame",
            domain="Emotion-bearing sentences",
        ),
        _stimulus_read,
        _stimulus_build,
    )
)

# --- GoodNewsEveryone ---------------------------------------------------------

# Label columns.
GOODNEWS_LABELS = (
    "anger", "annoyance", "disgust", "fear", "guilt", "joy", "love_including_like",
    "negative_anticipation_including_pessimism", "negative_surprise",
    "positive_anticipation_including_optimism", "positive_surprise", "pride", "sadness",
    "shame", "trust",
)


def _goodnews_read(spark: SparkSession, folder: str) -> Raws:
    schema = "id string, source string, headline string, dominant_emotion string, intensity string"
    return {
        "headlines": read_header_cast(spark, f"{folder}/*.tsv", schema, Dialect(sep="\t"))
    }


def _goodnews_build(raws: Raws) -> DataFrame:
    headlines = project(
        raws["headlines"],
        {
            "id": "id",
            "source": "source",
            "text": "headline",
            "dominant_emotion": "dominant_emotion",
            "intensity": "intensity",
        },
    )
    return pivot_flag(headlines, "dominant_emotion", GOODNEWS_LABELS)


register(
    Corpus(
        "GoodNewsEveryone",
        CorpusInfo(
            description="News headlines with the dominant emotion and its intensity.",
            citation="Bostan, Kim & Klinger 2020, GoodNewsEveryone",
            homepage="https://www.ims.uni-stuttgart.de/forschung/ressourcen/korpora/goodnewseveryone/",
            license="CC-BY 4.0",
            labels=("intensity", *GOODNEWS_LABELS),
            multilabel=False,
            continuous=False,
            system="Plutchik's emotions, extended",
            domain="News headlines",
        ),
        _goodnews_read,
        _goodnews_build,
    )
)

# --- ISEAR --------------------------------------------------------------------

# Label columns, and the code of each label.
ISEAR_LABELS = ("anger", "disgust", "fear", "guilt", "joy", "sadness", "shame")
ISEAR_CODES = {
    "1": "joy",
    "2": "fear",
    "3": "anger",
    "4": "sadness",
    "5": "disgust",
    "6": "shame",
    "7": "guilt",
}


def _isear_read(spark: SparkSession, folder: str) -> Raws:
    # Rows with too few or too many fields are left out, so the header-named
    # columns must be read whole before any is picked.
    path = f"{folder}/*.csv"
    dialect = Dialect(sep="|")
    header = spark.read.options(**dialect.options()).csv(path).columns
    whole = T.StructType([T.StructField(n, T.StringType()) for n in header])
    answers = read_delimited(spark, path, whole, dialect, bad_rows="drop")
    wanted = answers.select(
        parse_number(col("MYKEY"), "bigint").alias("MYKEY"), col("ID"), col("SIT"), col("EMOT")
    )
    return {"answers": wanted}


def _isear_build(raws: Raws) -> DataFrame:
    answers = raws["answers"].select(
        col("MYKEY").alias("id"),
        col("ID").alias("subject_id"),
        col("SIT").alias("text"),
        map_codes(col("EMOT").cast("string"), ISEAR_CODES).alias("emotion"),
    )
    wide = pivot_presence(answers, "emotion", ISEAR_LABELS)
    filled = wide.select(
        "id",
        "subject_id",
        "text",
        *[null_to(col(label), False).alias(label) for label in ISEAR_LABELS],
    )
    return filled  # the writer orders it, see ``order_by``


register(
    Corpus(
        "ISEAR",
        CorpusInfo(
            description="Survey answers on situations in which one of seven emotions was felt.",
            citation="Scherer & Wallbott 1994, Evidence for universality and cultural variation "
            "of differential emotion response patterning",
            homepage="https://www.unige.ch/cisa/research/materials-and-online-research/research-material/",
            license="CC BY-NC-SA 3.0",
            labels=ISEAR_LABELS,
            multilabel=False,
            continuous=False,
            system="Seven major emotions, recalled by the subject",
            domain="Descriptions of situations",
        ),
        _isear_read,
        _isear_build,
        order_by=("id",),
    )
)

# --- StockEmotions ------------------------------------------------------------

# Label columns.
STOCK_LABELS = (
    "ambiguous", "amusement", "anger", "anxiety", "belief", "confusion", "depression",
    "disgust", "excitement", "optimism", "panic", "surprise",
)


def _stock_read(spark: SparkSession, folder: str) -> Raws:
    path = f"{folder}/*.csv"
    dialect = Dialect()
    header = spark.read.options(**dialect.options()).csv(path).columns
    whole = T.StructType([T.StructField(n, T.StringType()) for n in header])
    return {"comments": read_delimited(spark, path, whole, dialect)}


def _stock_build(raws: Raws) -> DataFrame:
    # Every other raw column is a grouping column, also those not shown.
    wide = pivot_flag(raws["comments"], "emo_label", STOCK_LABELS)
    return wide.select(
        "id",
        "ticker",
        col("original").alias("text"),
        *cols(STOCK_LABELS),
        col("senti_label").alias("sentiment"),
    )


register(
    Corpus(
        "StockEmotions",
        CorpusInfo(
            description="Comments from a platform for investors, with emotion and sentiment.",
            citation="Lee et al. 2023, StockEmotions",
            homepage="https://github.com/adlnlp/StockEmotions/tree/main",
            license="",
            labels=(*STOCK_LABELS, "sentiment"),
            multilabel=False,
            continuous=False,
            system="Emotions of investors",
            domain="Social-media comments about stocks",
        ),
        _stock_read,
        _stock_build,
    )
)

# --- TEC ----------------------------------------------------------------------

# Label columns.
TEC_LABELS = ("anger", "disgust", "fear", "joy", "sadness", "surprise")


def _tec_read(spark: SparkSession, folder: str) -> Raws:
    return {"lines": read_lines(spark, f"{folder}/*.txt")}


def _tec_build(raws: Raws) -> DataFrame:
    """Lines are ``<id>:<tab>text, which may hold tabs<tab>:: <emotion>``."""
    line = F.col("value")
    fields = raws["lines"].select(
        right_strip_chars(split_item(line, "\t", 0), 1).cast("bigint").alias("id"),
        strip_text(join_middle(line, "\t")).alias("text"),
        strip_text(left_strip_chars(last_item(line, "\t"), 2)).alias("emotion"),
    )
    records = fields.select("id", html_unescape(col("text")).alias("text"), "emotion")
    return pivot_flag(records, "emotion", TEC_LABELS)


register(
    Corpus(
        "TEC",
        CorpusInfo(
            description="Tweets labelled by the emotion word in their hashtag.",
            citation="Mohammad 2012, #Emotional Tweets",
            homepage="https://saifmohammad.com/WebPages/SentimentEmotionLabeledData.html",
            license="",
            labels=TEC_LABELS,
            multilabel=False,
            continuous=False,
            system="Ekman's basic emotions",
            domain="Twitter posts",
        ),
        _tec_read,
        _tec_build,
    )
)

"""Corpora that need a projection only: one scan, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..columns import col, cols
from ..functions import as_flag, flag_if_present, project, row_mean
from ..sources import Dialect, read_delimited, read_header_cast, read_headerless, read_union_by_name
from .base import Corpus, CorpusInfo, Raws, register

# --- FBValenceArousal ---------------------------------------------------------

# Fixed value: the raw header.
FB_SCHEMA = (
    "`Anonymized Message` string, Valence1 float, Valence2 float, Arousal1 float, Arousal2 float"
)


def _fb_read(spark: SparkSession, folder: str) -> Raws:
    return {"posts": read_delimited(spark, f"{folder}/data.csv", FB_SCHEMA)}


def _fb_build(raws: Raws) -> DataFrame:
    posts = raws["posts"]

    def mean(stem: str):
        score = row_mean([col(f"{stem}1"), col(f"{stem}2")])
        # Two 32-bit ratings have a 32-bit mean.
        narrow = isinstance(posts.schema[f"{stem}1"].dataType, T.FloatType)
        return (score.cast("float") if narrow else score).alias(stem.lower())

    return posts.select(col("Anonymized Message").alias("text"), mean("Valence"), mean("Arousal"))


register(
    Corpus(
        "FBValenceArousal",
        CorpusInfo(
            description="Social-media posts rated by two psychologists for valence and arousal.",
            citation="Preotiuc-Pietro et al. 2016, Modelling valence and arousal in Facebook posts",
            homepage="https://github.com/wwbp/additional_data_sets/tree/master/valence_arousal",
            license="GPLv3",
            labels=("valence", "arousal"),
            multilabel=False,
            continuous=True,
            system="Valence and arousal scales",
            domain="Facebook posts",
        ),
        _fb_read,
        _fb_build,
    )
)

# --- GoEmotions ---------------------------------------------------------------

# Label columns and the columns before them.
GO_LABELS = (
    "admiration", "amusement", "anger", "annoyance", "approval", "caring", "confusion",
    "curiosity", "desire", "disappointment", "disapproval", "disgust", "embarrassment",
    "excitement", "fear", "gratitude", "grief", "joy", "love", "nervousness", "optimism",
    "pride", "realization", "relief", "remorse", "sadness", "surprise", "neutral",
)
GO_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("link_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("created_utc", T.FloatType()),
        T.StructField("rater_id", T.LongType()),
        T.StructField("example_very_unclear", T.StringType()),
        *[T.StructField(label, T.StringType()) for label in GO_LABELS],
    ]
)


def _go_read(spark: SparkSession, folder: str) -> Raws:
    return {"ratings": read_delimited(spark, f"{folder}/*.csv", GO_SCHEMA)}


def _go_build(raws: Raws) -> DataFrame:
    ratings = raws["ratings"]
    flags = ("example_very_unclear", *GO_LABELS)
    # Flags are written as 0/1 or True/False, so they arrive as text.
    return ratings.select(
        *[as_flag(col(f.name)).alias(f.name) if f.name in flags else col(f.name) for f in GO_SCHEMA]
    )


register(
    Corpus(
        "GoEmotions",
        CorpusInfo(
            description="Reddit comments with 27 emotions or neutral; one row per rater.",
            citation="Demszky et al. 2020, GoEmotions: A Dataset of Fine-Grained Emotions",
            homepage="https://github.com/google-research/google-research/tree/master/goemotions",
            license="",
            labels=GO_LABELS,
            multilabel=True,
            continuous=False,
            system="27 emotions in a hierarchy, and neutral",
            domain="Reddit posts",
        ),
        _go_read,
        _go_build,
    )
)

# --- Semeval2018Classification ------------------------------------------------

# Label columns.
SEMEVAL_LABELS = (
    "anger", "anticipation", "disgust", "fear", "joy", "love", "optimism", "pessimism",
    "sadness", "surprise", "trust",
)


def _semeval_read(spark: SparkSession, folder: str) -> Raws:
    fields = ["ID string", "Tweet string", *[f"{label} int" for label in SEMEVAL_LABELS]]
    unquoted = Dialect(sep="\t", quote="", multi_line=False)
    return {"tweets": read_delimited(spark, f"{folder}/E-c/*.txt", ", ".join(fields), unquoted)}


def _semeval_build(raws: Raws) -> DataFrame:
    return raws["tweets"].select(
        col("ID").alias("id"),
        col("Tweet").alias("text"),
        *[as_flag(col(label)).alias(label) for label in SEMEVAL_LABELS],
    )


register(
    Corpus(
        "Semeval2018Classification",
        CorpusInfo(
            description="Tweets labelled for the presence of eleven emotions.",
            citation="Mohammad et al. 2018, SemEval-2018 Task 1: Affect in Tweets",
            homepage="https://competitions.codalab.org/competitions/17751#learn_the_details-overview",
            license="",
            labels=SEMEVAL_LABELS,
            multilabel=True,
            continuous=False,
            system="Presence of emotions common on Twitter",
            domain="Twitter posts",
        ),
        _semeval_read,
        _semeval_build,
    )
)

# --- SentimentalLIAR ----------------------------------------------------------

# The columns kept.
LIAR_TEXT = ("ID", "statement", "subject", "speaker", "context", "sentiment")
LIAR_SCORES = ("sentiment_score", "anger", "fear", "joy", "disgust", "sad")


def _liar_read(spark: SparkSession, folder: str) -> Raws:
    statements = read_union_by_name(spark, f"{folder}/*.csv")
    scored = [col(n).cast("double").alias(n) for n in LIAR_SCORES]
    return {"statements": statements.select(*cols(LIAR_TEXT), *scored)}


def _liar_build(raws: Raws) -> DataFrame:
    return raws["statements"].select(*cols(LIAR_TEXT), *cols(LIAR_SCORES))


register(
    Corpus(
        "SentimentalLIAR",
        CorpusInfo(
            description="Short political claims with machine-made sentiment and emotion scores.",
            citation="Upadhayay & Behzadan 2020, Sentimental LIAR",
            homepage="https://github.com/UNHSAILLab/SentimentalLIAR",
            license="",
            labels=("sentiment", "anger", "fear", "joy", "disgust", "sad"),
            multilabel=True,
            continuous=True,
            system="Scores from two commercial language services",
            domain="Statements of politicians and other public figures",
        ),
        _liar_read,
        _liar_build,
    )
)

# --- SSEC ---------------------------------------------------------------------

# Label columns, and the token for "not marked".
PLUTCHIK = (
    "anger", "anticipation", "disgust", "fear", "joy", "sadness", "surprise", "trust",
)
SSEC_UNMARKED = "---"


def _ssec_read(spark: SparkSession, folder: str) -> Raws:
    schema = ", ".join([*[f"{label} string" for label in PLUTCHIK], "text string"])
    dialect = Dialect(sep="\t", null_token=SSEC_UNMARKED)
    return {"tweets": read_headerless(spark, f"{folder}/*.csv", schema, dialect, bad_rows="drop")}


def _ssec_build(raws: Raws) -> DataFrame:
    flags = [flag_if_present(col(label)).alias(label) for label in PLUTCHIK]
    return raws["tweets"].select("text", *flags)


register(
    Corpus(
        "SSEC",
        CorpusInfo(
            description="Stance-detection tweets annotated with eight emotions.",
            citation="Schuff et al. 2017, Annotation, modelling and analysis of fine-grained "
            "emotions on a stance and sentiment detection corpus",
            homepage="https://www.romanklinger.de/ssec/",
            license="",
            labels=PLUTCHIK,
            multilabel=True,
            continuous=False,
            system="Eight emotions after Plutchik and Ekman",
            domain="Twitter posts",
        ),
        _ssec_read,
        _ssec_build,
    )
)

# --- UsVsThem -----------------------------------------------------------------

# Label columns; the raw name of the last one differs.
USVSTHEM_LABELS = (
    "anger", "contempt", "disgust", "fear", "gratitude", "guilt", "happiness", "hope",
    "pride", "relief", "sadness", "sympathy", "neutral",
)
USVSTHEM_NEUTRAL = "emotions_neutral"


def _usvsthem_read(spark: SparkSession, folder: str) -> Raws:
    named = [n for n in USVSTHEM_LABELS if n != "neutral"] + [USVSTHEM_NEUTRAL]
    schema = T.StructType(
        [
            T.StructField("bias", T.StringType()),
            T.StructField("group", T.StringType()),
            T.StructField("usVSthem_scale", T.DoubleType()),
            T.StructField("body", T.StringType()),
            *[T.StructField(n, T.IntegerType()) for n in named],
        ]
    )
    return {"comments": read_header_cast(spark, f"{folder}/*.csv", schema)}


def _usvsthem_build(raws: Raws) -> DataFrame:
    columns = {"bias": "bias", "group": "group", "usVSthem_scale": "usVSthem_scale", "text": "body"}
    columns |= {n: USVSTHEM_NEUTRAL if n == "neutral" else n for n in USVSTHEM_LABELS}
    return project(raws["comments"], columns)


register(
    Corpus(
        "UsVsThem",
        CorpusInfo(
            description="Reddit comments annotated for populist attitudes and emotions.",
            citation="Huguet-Cabot et al. 2021, Us vs. Them: A Dataset of Populist Attitudes, "
            "News Bias and Emotions",
            homepage="https://github.com/LittlePea13/UsVsThem",
            license="CC BY-NC 4.0",
            labels=USVSTHEM_LABELS,
            multilabel=True,
            continuous=False,
            system="Emotions tied to populist attitudes",
            domain="Reddit posts",
        ),
        _usvsthem_read,
        _usvsthem_build,
    )
)


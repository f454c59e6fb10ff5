"""Corpora spread over one file per label, or per label and split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, cols
from ..functions import as_flag, null_to, project, title_case
from ..operators import (
    full_outer_merge,
    gather_lists,
    long_to_wide,
    pivot_any_value,
    pivot_mean,
    pivot_sum,
    unpivot,
)
from ..sources import Dialect, read_delimited, read_header_cast, read_headerless
from .base import Corpus, CorpusInfo, Raws, register
from .direct import PLUTCHIK

# --- CancerEmo ----------------------------------------------------------------


def _canceremo_read(spark: SparkSession, folder: str) -> Raws:
    raws = {}
    for label in PLUTCHIK:
        raw_name = title_case(label)
        schema = T.StructType(
            [T.StructField("Sentence", T.StringType()), T.StructField(raw_name, T.IntegerType())]
        )
        raws[label] = read_header_cast(spark, f"{folder}/{raw_name}_anon.csv", schema)
    return raws


def _canceremo_build(raws: Raws) -> DataFrame:
    """A null cell means the text was not annotated for that label."""
    long = []
    for label in PLUTCHIK:
        named = raws[label].select(
            col("Sentence").alias("text"), as_flag(col(title_case(label))).alias(label)
        )
        long.append(unpivot(named, [label], "emotion", "label", keep=["text"]))
    return long_to_wide(long, pivot_any_value, "emotion", PLUTCHIK, "label")


register(
    Corpus(
        "CancerEmo",
        CorpusInfo(
            description="Sentences from an online health community, annotated per emotion.",
            citation="Sosea & Caragea 2020, CancerEmo: A Dataset for Fine-Grained Emotion Detection",
            homepage="https://github.com/tsosea2/CancerEmo?tab=readme-ov-file",
            license="",
            labels=PLUTCHIK,
            multilabel=True,
            continuous=False,
            system="Plutchik's eight emotions",
            domain="Internet forum of cancer survivors",
        ),
        _canceremo_read,
        _canceremo_build,
    )
)

# --- Hurricanes8 --------------------------------------------------------------

# Label columns.
HURRICANES8_LABELS = (
    "aggressiveness", "awe", "contempt", "disapproval", "love", "optimism", "remorse",
    "submission",
)


def _hurricanes8_read(spark: SparkSession, folder: str) -> Raws:
    return {
        label: read_header_cast(spark, f"{folder}/{label}*.csv", f"text string, {label} int")
        for label in HURRICANES8_LABELS
    }


def _hurricanes8_build(raws: Raws) -> DataFrame:
    """A text missing from a label's files counts as not carrying the label."""
    long = [
        unpivot(raws[label].select("text", label), [label], "emotion", "value", keep=["text"])
        for label in HURRICANES8_LABELS
    ]
    wide = long_to_wide(long, pivot_sum, "emotion", HURRICANES8_LABELS, "value")
    return wide.select(
        "text", *[as_flag(null_to(col(n), 0)).alias(n) for n in HURRICANES8_LABELS]
    )


register(
    Corpus(
        "Hurricanes8",
        CorpusInfo(
            description="Tweets about three hurricanes, with eight binary emotions.",
            citation="Desai, Caragea & Li 2020, Detecting Perceived Emotions in Hurricane Disasters",
            homepage="https://github.com/shreydesai/hurricane/tree/master",
            license="",
            labels=HURRICANES8_LABELS,
            multilabel=True,
            continuous=False,
            system="Plutchik's eight dyads",
            domain="Twitter posts about hurricanes",
        ),
        _hurricanes8_read,
        _hurricanes8_build,
    )
)

# --- EmoInt -------------------------------------------------------------------

# Label columns.
INTENSITY_LABELS = ("anger", "fear", "joy", "sadness")


def _emoint_read(spark: SparkSession, folder: str) -> Raws:
    schema = "id int, text string, emotion string, intensity float"
    unquoted = Dialect(sep="\t", quote="", multi_line=False)
    return {"ratings": read_headerless(spark, f"{folder}/*.csv", schema, unquoted)}


def _emoint_build(raws: Raws, **gather_options) -> DataFrame:
    ratings = raws["ratings"].select("id", "text", "emotion", "intensity")
    wide = pivot_sum(ratings, "emotion", INTENSITY_LABELS, "intensity")
    return gather_lists(
        wide,
        keys=["text"],
        lists={"ids": "id"},
        order_by=["id"],
        aggs=[F.avg(col(n)).alias(n) for n in INTENSITY_LABELS],
        **gather_options,
    ).select("ids", "text", "part", *INTENSITY_LABELS)


register(
    Corpus(
        "EmoInt",
        CorpusInfo(
            description="Tweets with the intensity of each of four emotions.",
            citation="Mohammad & Bravo-Marquez 2017, WASSA-2017 Shared Task on Emotion Intensity",
            homepage="http://saifmohammad.com/WebPages/EmotionIntensity-SharedTask.html",
            license="",
            labels=INTENSITY_LABELS,
            multilabel=True,
            continuous=True,
            system="Four common emotions, rated by best-worst scaling",
            domain="Twitter posts",
        ),
        _emoint_read,
        _emoint_build,
    )
)

# --- Semeval2018Intensity -----------------------------------------------------

# The raw header, in order.
SEMEVAL_INTENSITY_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("Tweet", T.StringType()),
        T.StructField("Affect Dimension", T.StringType()),
        T.StructField("Intensity Score", T.DoubleType()),
    ]
)


def _semeval_read(spark: SparkSession, folder: str) -> Raws:
    unquoted = Dialect(sep="\t", quote="", multi_line=False)

    def scan(pattern: str) -> DataFrame:
        return read_delimited(spark, f"{folder}/{pattern}", SEMEVAL_INTENSITY_SCHEMA, unquoted)

    return {"intensity": scan("EI-reg/*/*.txt"), "valence": scan("V-reg/*.txt")}


def _semeval_build(raws: Raws, coalesce_keys: bool = True) -> DataFrame:
    """Both sides are pivoted first, so the join sees each key once."""

    def wide(raw: DataFrame, labels: tuple[str, ...]) -> DataFrame:
        named = project(
            raw,
            {"id": "ID", "text": "Tweet", "dimension": "Affect Dimension", "score": "Intensity Score"},
        )
        return pivot_mean(named, "dimension", labels, "score")

    merged = full_outer_merge(
        wide(raws["intensity"], INTENSITY_LABELS),
        wide(raws["valence"], ("valence",)),
        ["id", "text"],
        coalesce_keys,
    )
    return merged.select(*cols(["id", "text", "valence", *INTENSITY_LABELS]))


register(
    Corpus(
        "Semeval2018Intensity",
        CorpusInfo(
            description="Tweets with the intensity of four emotions and of valence.",
            citation="Mohammad et al. 2018, SemEval-2018 Task 1: Affect in Tweets",
            homepage="https://competitions.codalab.org/competitions/17751#learn_the_details-overview",
            license="",
            labels=(*INTENSITY_LABELS, "valence"),
            multilabel=True,
            continuous=True,
            system="Intensity of basic emotions",
            domain="Twitter posts",
        ),
        _semeval_read,
        _semeval_build,
    )
)

"""Corpora put together from two files of different shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..columns import col, cols
from ..functions import null_to, project
from ..operators import append_by_position, join_on, pivot_presence, positional_join
from ..sources import Dialect, read_delimited, read_header_cast, read_headerless
from .base import Corpus, CorpusInfo, Raws, register

# --- EmoBank ------------------------------------------------------------------


def _emobank_read(spark: SparkSession, folder: str) -> Raws:
    return {
        "data": read_delimited(
            spark,
            f"{folder}/emobank.csv",
            "id string, split string, V float, A float, D float, text string",
        ),
        "meta": read_delimited(
            spark,
            f"{folder}/meta.tsv",
            "id string, document string, category string, subcategory string",
            Dialect(sep="\t"),
        ),
    }


def _emobank_build(raws: Raws) -> DataFrame:
    return join_on(raws["data"], raws["meta"], ["id"]).select(
        *cols(["id", "document", "category", "subcategory", "split", "V", "A", "D", "text"])
    )


register(
    Corpus(
        "EmoBank",
        CorpusInfo(
            description="Sentences of many genres rated for valence, arousal and dominance.",
            citation="Buechel & Hahn 2017, EmoBank: Studying the impact of annotation perspective "
            "and representation format on dimensional emotion analysis",
            homepage="https://github.com/JULIELab/EmoBank/tree/master",
            license="CC-BY-SA 4.0",
            labels=("V", "A", "D"),
            multilabel=False,
            continuous=True,
            system="Valence, arousal, dominance",
            domain="Varied",
        ),
        _emobank_read,
        _emobank_build,
    )
)

# --- WASSA22 ------------------------------------------------------------------

# Label columns.
WASSA_LABELS = ("anger", "disgust", "fear", "joy", "neutral", "sadness", "surprise")


def _wassa_read(spark: SparkSession, folder: str) -> Raws:
    return {
        "train": read_header_cast(
            spark,
            f"{folder}/train.csv",
            "message_id string, article_id string, essay string, emotion string, "
            "empathy float, distress float",
        ),
        "dev_features": read_header_cast(
            spark,
            f"{folder}/dev_features.csv",
            "message_id string, article_id string, essay string",
        ),
        "dev_labels": read_headerless(
            spark, f"{folder}/dev_labels.csv", "empathy float, distress float, emotion string"
        ),
    }


def _wassa_build(raws: Raws, parquet: bool = False) -> DataFrame:
    """Dev labels carry no key: they belong to the features in the same row.

    The dev frames must be file scans (``parquet`` tells which kind), because
    only those have a row order.
    """
    named = {"id": "message_id", "article_id": "article_id", "text": "essay"}
    scores = {"emotion": "emotion", "empathy": "empathy", "distress": "distress"}
    train = project(raws["train"], {**named, **scores})
    dev = positional_join(raws["dev_features"], raws["dev_labels"], parquet, parquet)
    dev = project(dev, {**named, **scores})
    wide = pivot_presence(append_by_position(train, dev), "emotion", WASSA_LABELS)
    return wide.select(
        *cols(["id", "article_id", "text", "empathy", "distress"]),
        *[null_to(col(n), False).alias(n) for n in WASSA_LABELS],
    )


register(
    Corpus(
        "WASSA22",
        CorpusInfo(
            description="Essays reacting to news stories, with emotion, empathy and distress.",
            citation="Barriere et al. 2022, WASSA 2022 Shared Task",
            homepage="https://codalab.lisn.upsaclay.fr/competitions/834#learn_the_details-overview",
            license="",
            labels=(*WASSA_LABELS, "empathy", "distress"),
            multilabel=False,
            continuous=False,
            system="Ekman's basic emotions, with empathy and distress scores",
            domain="Essays",
        ),
        _wassa_read,
        _wassa_build,
    )
)

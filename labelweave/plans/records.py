"""Corpora whose records are parsed line by line or merged by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col
from ..functions import (
    drop_columns,
    map_codes,
    multi_hot,
    normalize_columns,
    one_hot,
    rescale_percent,
    strip_text,
)
from ..operators import append_by_name, keep_parseable, merge_by_key
from ..sources import (
    Dialect,
    load_splits,
    read_by_header,
    read_headerless,
    read_lines,
    redecode_utf7,
    regex_records,
)
from .base import Corpus, CorpusInfo, Raws, register

# --- AffectiveText ------------------------------------------------------------

# Splits in order of precedence, label columns, record format.
AFFECTIVE_SPLITS = ("trial", "test")
AFFECTIVE_LABELS = ("anger", "disgust", "fear", "joy", "sadness", "surprise")
AFFECTIVE_RECORD = r'^<instance id="(.*?)">(.*?)</instance>'
AFFECTIVE_PREFIX = (2, "instance")


def _affective_read(spark: SparkSession, folder: str, strict: bool = False) -> Raws:
    """Six frames: text, emotions and valence of each split, in file order."""
    spaced = Dialect(sep=" ", multi_line=False)
    scores = ", ".join(f"{n} int" for n in AFFECTIVE_LABELS)
    raws: Raws = {}
    for split in AFFECTIVE_SPLITS:
        stem = f"{folder}/AffectiveText.{split}/affectivetext_{split}"
        raws[f"{split}_text"] = regex_records(
            read_lines(spark, f"{stem}.xml"),
            AFFECTIVE_RECORD,
            ("id", "text"),
            prefix=AFFECTIVE_PREFIX,
            strict=strict,
        ).withColumn("id", F.col("id").cast("int"))
        raws[f"{split}_emotions"] = read_headerless(
            spark, f"{stem}.emotions.gold", f"id int, {scores}", spaced
        )
        raws[f"{split}_valence"] = read_headerless(
            spark, f"{stem}.valence.gold", "id int, valence int", spaced
        )
    return raws


def _affective_build(raws: Raws) -> DataFrame:
    sources = []
    for split in AFFECTIVE_SPLITS:
        sources.append(raws[f"{split}_text"])
        for part, labels in (("emotions", AFFECTIVE_LABELS), ("valence", ("valence",))):
            sources.append(
                raws[f"{split}_{part}"].select(
                    "id", *[rescale_percent(col(n)).alias(n) for n in labels]
                )
            )
    columns = {"text": "string"} | {n: "double" for n in (*AFFECTIVE_LABELS, "valence")}
    return merge_by_key(sources, "id", columns)


register(
    Corpus(
        "AffectiveText",
        CorpusInfo(
            description="News headlines scored for six emotions and for valence.",
            citation="Strapparava & Mihalcea 2007, SemEval-2007 Task 14: Affective Text",
            homepage="https://web.eecs.umich.edu/~mihalcea/downloads.html#affective",
            license="",
            labels=(*AFFECTIVE_LABELS, "valence"),
            multilabel=True,
            continuous=True,
            system="Continuous rating per emotion",
            domain="News headlines",
        ),
        _affective_read,
        _affective_build,
    )
)

# --- CARER --------------------------------------------------------------------

# Splits, and the code of each label.
CARER_SPLITS = ("train", "validation", "test")
CARER_CODES = {
    0: "sadness",
    1: "joy",
    2: "love",
    3: "anger",
    4: "fear",
    5: "surprise",
}


def _carer_read(spark: SparkSession, folder: str) -> Raws:
    schema = "text string, label int"
    return {s: spark.read.schema(schema).parquet(f"{folder}/{s}*.parquet") for s in CARER_SPLITS}


def _carer_build(raws: Raws) -> DataFrame:
    rows = load_splits({s: raws[s].select("text", "label") for s in CARER_SPLITS}, None)
    named = rows.withColumn("emotion", map_codes(col("label").cast("int"), CARER_CODES, strict=True))
    flagged = named.select("*", *one_hot(col("emotion"), CARER_CODES.values()))
    return drop_columns(flagged, "label", "emotion")


register(
    Corpus(
        "CARER",
        CorpusInfo(
            description="English tweets with one of six emotions.",
            citation="Saravia et al. 2018, CARER: Contextualized Affect Representations for "
            "Emotion Recognition",
            homepage="https://github.com/dair-ai/emotion_dataset",
            license="The dataset should be used for educational and research purposes only.",
            labels=tuple(sorted(CARER_CODES.values())),
            multilabel=False,
            continuous=False,
            system="Hashtags that stand for Ekman's emotions",
            domain="Twitter posts",
        ),
        _carer_read,
        _carer_build,
    )
)

# --- REN20k -------------------------------------------------------------------

# Label columns, and the raw name of the text column.
REN_LABELS = ("happy", "sad", "angry", "don't care", "inspired", "afraid", "amused", "annoyed")
REN_RENAMES = {"content": "text"}


def _ren_read(spark: SparkSession, folder: str) -> Raws:
    """One raw frame per distinct header; text cells are repaired here.

    Decoding cells rather than lines keeps an encoded quote or comma data, and
    leaves numbers out of Python. A row with too few fields is left out; surplus
    fields are ignored.
    """
    raws = {}
    for i, frame in enumerate(read_by_header(spark, f"{folder}/*/*/*.csv", malformed="_bad")):
        names = [n for n in frame.columns if n != "_bad"]
        whole = frame.filter(F.col("_bad").isNull() | col(names[-1]).isNotNull())
        cells = []
        for n in names:
            # A cell left empty is an empty string here, not a missing one.
            cell = F.coalesce(col(n), F.lit(""))
            is_number = n.strip().lower() in REN_LABELS
            cells.append((cell if is_number else redecode_utf7(cell)).alias(n))
        raws[f"part{i}"] = whole.select(*cells)
    return raws


def _ren_build(raws: Raws) -> DataFrame:
    """Columns other than the labels pass through, stripped; absent ones are null."""
    parts = []
    for raw in raws.values():
        named = normalize_columns(raw, REN_RENAMES)
        carried = [n for n in named.columns if n not in REN_LABELS]
        percents = [n for n in named.columns if n in REN_LABELS]
        stripped = named.select(
            *[strip_text(col(n)).alias(n) for n in carried], *[col(n) for n in percents]
        )
        parts.append(keep_parseable(stripped, percents, carried))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    carried = [n for n in merged.columns if n not in REN_LABELS and n != "text"]
    # A label no file holds is still a column of the result.
    labels = [
        (col(n) if n in merged.columns else F.lit(None).cast(T.DoubleType())).alias(n)
        for n in REN_LABELS
    ]
    return merged.select(*[col(n) for n in carried], "text", *labels)


register(
    Corpus(
        "REN20k",
        CorpusInfo(
            description="News articles with the share of readers that felt each of eight moods.",
            citation="Kadan et al. 2024, REDAffectiveLM",
            homepage="https://dcs.uoc.ac.in/cida/resources/ren-20k.html",
            license="CC-BY-NC",
            labels=REN_LABELS,
            multilabel=True,
            continuous=True,
            system="Emotions evoked in many readers",
            domain="News articles",
        ),
        _ren_read,
        _ren_build,
    )
)

# --- XED ----------------------------------------------------------------------

# The code of each label.
XED_CODES = {
    "1": "anger",
    "2": "anticipation",
    "3": "disgust",
    "4": "fear",
    "5": "joy",
    "6": "sadness",
    "7": "surprise",
    "8": "trust",
    "9": "neutral",
}


def _xed_read(spark: SparkSession, folder: str) -> Raws:
    tab = Dialect(sep="\t")
    return {
        "annotated": read_headerless(
            spark, f"{folder}/emotion.tsv", "text string, labels string", tab
        ),
        # Lines that do not have exactly two fields are left out.
        "neutral": read_headerless(
            spark, f"{folder}/neutral.tsv", "label string, text string", tab, bad_rows="drop"
        ),
    }


def _xed_build(raws: Raws) -> DataFrame:
    annotated = raws["annotated"].select("text", *multi_hot(col("labels"), XED_CODES))
    neutral = raws["neutral"].select("text", *one_hot(F.lit("neutral"), XED_CODES.values()))
    return append_by_name(annotated, neutral)


register(
    Corpus(
        "XED",
        CorpusInfo(
            description="Film subtitles with any of eight emotions, or neutral; the English part.",
            citation="Ohman et al. 2020, XED: A multilingual dataset for sentiment analysis and "
            "emotion detection",
            homepage="https://github.com/Helsinki-NLP/XED/tree/master",
            license="",
            labels=tuple(XED_CODES.values()),
            multilabel=True,
            continuous=False,
            system="Plutchik's core emotions",
            domain="Subtitles",
        ),
        _xed_read,
        _xed_build,
    )
)

"""Corpora with several annotations per text, kept as votes."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col
from ..functions import map_codes, pair_votes, project, split_item, vote_counts
from ..operators import (
    append_by_name,
    gather_lists,
    natural_self_map,
    open_vote_counts,
    pivot_presence,
)
from ..sources import Dialect, read_delimited, read_json_records, with_path_parts
from ..sources.delimited import as_schema
from .base import Corpus, CorpusInfo, Raws, register

# --- ElectoralTweets ----------------------------------------------------------

# Label columns, answer codes, and the raw question columns. The
# valence question differs between the two batches by one digit.
ELECTORAL_LABELS = (
    "acceptance",
    "admiration",
    "amazement",
    "anger or annoyance or hostility or fury",
    "anticipation or  expectancy or interest",
    "calmness or serenity",
    "disappointment",
    "disgust",
    "dislike",
    "fear or apprehension or panic or terror",
    "hate",
    "indifference",
    "joy or happiness or elation",
    "like",
    "sadness or gloominess or grief or sorrow",
    "surprise",
    "trust",
    "uncertainty or indecision or confusion",
    "vigilance",
)
VALENCE_CODES = {
    "neither positive nor negative": "neutral",
    "negative emotion": "negative",
    "positive emotion": "positive",
}
AROUSAL_CODES = {
    "the emotion is being expressed with a high intensity": "high",
    "the emotion is being expressed with medium intensity": "medium",
    "the emotion is being expressed with a low intensity": "low",
}
EMOTION_QUESTION = (
    "q2whatemotionchooseoneoftheoptionsfrombelowthatbestrepresentstheemotion"
)
AROUSAL_QUESTION = (
    "fontcolorolivetweetertweetfontbrq5howstronglyistheemotionbeingexpressedinthistweet"
)
VALENCE_QUESTIONS = {
    "Batch1": "q4ifwhenansweringq2youhavechosenanemotionfromtheotheremotionscategoryorifyouansweredq4thenpleasetellusiftheemotioninthistweetispositivenegativeorneither",
    "Batch2": "q4ifwhenansweringq2youhavechosenanemotionfromtheotheremotionscategoryorifyouansweredq3thenpleasetellusiftheemotioninthistweetispositivenegativeorneither",
}
UNANSWERED = "BLANK"


def _electoral_read(spark: SparkSession, folder: str) -> Raws:
    raws = {}
    for batch, valence in VALENCE_QUESTIONS.items():
        path = f"{folder}/{batch}/AnnotatedTweets.txt"
        dialect = Dialect(sep="\t", null_token=UNANSWERED)
        header = spark.read.options(**dialect.options()).csv(path).columns
        types = {"id": T.IntegerType(), "trust": T.FloatType()}
        whole = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])
        raws[batch] = project(
            read_delimited(spark, path, whole, dialect, bad_rows="drop"),
            {
                "id": "id",
                "annotator_trust": "trust",
                "text": "tweet",
                "emotion": EMOTION_QUESTION,
                "valence": valence,
                "arousal": AROUSAL_QUESTION,
            },
        )
    return raws


def _electoral_build(raws: Raws, **gather_options) -> DataFrame:
    """Aligned lists of each text's annotations, votes per emotion on part 0."""
    answers = append_by_name(*[raws[b] for b in VALENCE_QUESTIONS])
    wide = pivot_presence(answers, "emotion", ELECTORAL_LABELS)
    mapped = natural_self_map(
        wide,
        "id",
        {
            "_valence": map_codes(col("valence"), VALENCE_CODES),
            "_arousal": map_codes(col("arousal"), AROUSAL_CODES),
        },
    )
    return gather_lists(
        mapped,
        keys=["text"],
        lists={
            "ids": "id",
            "annotator_trusts": "annotator_trust",
            "valence": "_valence",
            "arousal": "_arousal",
        },
        order_by=["id"],
        aggs=[F.count(col(n)).alias(n) for n in ELECTORAL_LABELS],
        **gather_options,
    ).select(
        "ids", "annotator_trusts", "text", "part", "valence", "arousal", *[col(n) for n in ELECTORAL_LABELS]
    )


register(
    Corpus(
        "ElectoralTweets",
        CorpusInfo(
            description="Tweets on the 2012 US presidential election, annotated by many workers.",
            citation="Mohammad et al. 2015, Sentiment, emotion, purpose, and style in electoral "
            "tweets",
            homepage="http://saifmohammad.com/WebPages/SentimentEmotionLabeledData.html",
            license="",
            labels=("valence", "arousal", *ELECTORAL_LABELS),
            multilabel=True,
            continuous=False,
            system="Discrete categories, some of them groups of emotions",
            domain="Twitter posts",
        ),
        _electoral_read,
        _electoral_build,
    )
)

# --- Hurricanes24 -------------------------------------------------------------

# Label columns.
HURRICANES24_LABELS = (
    "admiration", "ecstasy", "interest", "sadness", "vigilance", "acceptance", "amazement",
    "anger", "annoyance", "anticipation", "apprehension", "boredom", "disgust", "distraction",
    "fear", "grief", "joy", "loathing", "pensiveness", "rage", "serenity", "surprise",
    "terror", "trust",
)
# The label list is closed, so each worker's answers are a struct, not a map.
HURRICANES24_SCHEMA = "text string, annotations map<string, struct<{}>>".format(
    ", ".join(f"{name}: boolean" for name in HURRICANES24_LABELS)
)

# The same with labels of any name.
HURRICANES24_OPEN_SCHEMA = "text string, annotations map<string, map<string, boolean>>"


def _hurricanes24_read(spark: SparkSession, folder: str) -> Raws:
    tweets = read_json_records(spark, f"{folder}/*.jsonl", HURRICANES24_SCHEMA)
    return {"tweets": with_path_parts(tweets, r"([^/]+)\.jsonl$", ["hurricane"])}


def _hurricanes24_build(raws: Raws) -> DataFrame:
    """Votes per label. Answers read as maps of label to flag may name further labels:
    their votes are in the map ``other``."""
    keep = ["hurricane", "text"]
    answers = raws["tweets"].schema["annotations"].dataType.valueType
    if isinstance(answers, T.MapType):
        return open_vote_counts(raws["tweets"], "annotations", HURRICANES24_LABELS, keep)
    return vote_counts(raws["tweets"], "annotations", HURRICANES24_LABELS, keep)


register(
    Corpus(
        "Hurricanes24",
        CorpusInfo(
            description="Tweets about three hurricanes, with votes on 24 emotions.",
            citation="Desai, Caragea & Li 2020, Detecting Perceived Emotions in Hurricane Disasters",
            homepage="https://github.com/shreydesai/hurricane/tree/master",
            license="",
            labels=HURRICANES24_LABELS,
            multilabel=True,
            continuous=False,
            system="Plutchik's 24 emotions",
            domain="Twitter posts about hurricanes",
        ),
        _hurricanes24_read,
        _hurricanes24_build,
    )
)

# --- TalesEmotions ------------------------------------------------------------

# The code of each label.
TALES_CODES = {
    "A": "angry",
    "D": "disgusted",
    "F": "fearful",
    "H": "happy",
    "N": "neutral",
    "Sa": "sad",
    "Su+": "positively surprised",
    "Su-": "negatively surprised",
}
TALES_SCHEMA = "sent string, primary string, mood string, text string"


def _tales_read(spark: SparkSession, folder: str) -> Raws:
    dialect = Dialect(sep="\t", quote="`", escape="\\", header=False, line_sep="\n")
    scan = read_delimited(
        spark, f"{folder}/*/*/emmood/*.emmood", as_schema(TALES_SCHEMA), dialect
    )
    pattern = r"([^/]+)/[^/]+/emmood/([^/]+)\.emmood$"
    return {"sentences": with_path_parts(scan, pattern, ["author", "story"])}


def _tales_build(raws: Raws, first_rater_twice: bool = False) -> DataFrame:
    """Votes of two raters per sentence.

    ``first_rater_twice`` counts the first rater for both, giving 0 or 2.
    """
    codes = [split_item(col("primary"), ":", i) for i in ((0, 0) if first_rater_twice else (0, 1))]
    first = map_codes(codes[0], TALES_CODES, strict=True)
    second = F.when(codes[1].isNotNull(), map_codes(codes[1], TALES_CODES, strict=True))
    rated = raws["sentences"].select(
        "author",
        "story",
        split_item(col("sent"), ":", 0).alias("sent_id"),
        "text",
        first.alias("_first"),
        second.alias("_second"),
    )
    votes = pair_votes([F.col("_first"), F.col("_second")], TALES_CODES.values())
    return rated.select("author", "story", "sent_id", "text", *votes)


register(
    Corpus(
        "TalesEmotions",
        CorpusInfo(
            description="Sentences of fairy tales, labelled by two raters.",
            citation="Alm, Roth & Sproat 2005, Emotions from Text",
            homepage="http://people.rc.rit.edu/~coagla/affectdata/index.html",
            license="GPLv3",
            labels=tuple(TALES_CODES.values()),
            multilabel=False,
            continuous=False,
            system="Ekman's basic emotions",
            domain="Fairy tales",
        ),
        _tales_read,
        _tales_build,
    )
)

"""What a corpus plan is, and the registry of them.

A plan has two halves. ``read(spark, folder)`` scans the raw files into named
raw frames. ``build(raws, **options)`` is pure: frames in, one wide frame out,
nothing evaluated but the size checks it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Raws = dict[str, DataFrame]


@dataclass(frozen=True)
class CorpusInfo:
    """Documentation of a corpus; ``labels`` are the label columns it produces."""

    description: str
    citation: str
    homepage: str
    license: str
    labels: tuple[str, ...]
    multilabel: bool
    continuous: bool
    system: str
    domain: str


@dataclass(frozen=True)
class Corpus:
    name: str
    info: CorpusInfo
    read: Callable[[SparkSession, str], Raws]
    build: Callable[..., DataFrame]
    # Columns the written rows are ordered by, if any.
    order_by: tuple[str, ...] = ()


CORPORA: dict[str, Corpus] = {}


def register(corpus: Corpus) -> Corpus:
    if corpus.name in CORPORA:
        raise ValueError(f"corpus {corpus.name!r} is registered twice")
    CORPORA[corpus.name] = corpus
    return corpus


def get_corpus(name: str) -> Corpus:
    """Look a corpus up by name, ignoring case."""
    for known, corpus in CORPORA.items():
        if known.lower() == name.lower():
            return corpus
    raise KeyError(f"corpus {name!r} is not known; choose one of {sorted(CORPORA)}")


CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("citation", T.StringType()),
        T.StructField("homepage", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("emotions", T.ArrayType(T.StringType())),
        T.StructField("multilabel", T.BooleanType()),
        T.StructField("continuous", T.BooleanType()),
        T.StructField("system", T.StringType()),
        T.StructField("domain", T.StringType()),
    ]
)


def catalog(spark: SparkSession) -> DataFrame:
    """One documentation row per corpus."""
    rows = [
        (
            c.name,
            c.info.description,
            c.info.citation,
            c.info.homepage,
            c.info.license,
            list(c.info.labels),
            c.info.multilabel,
            c.info.continuous,
            c.info.system,
            c.info.domain,
        )
        for c in CORPORA.values()
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)

"""The corpora this library harmonises, one plan each."""

from . import direct, joined, longwide, pivoted, records, votes  # noqa: F401
from .base import CORPORA, Corpus, CorpusInfo, catalog, get_corpus

__all__ = ["CORPORA", "Corpus", "CorpusInfo", "catalog", "get_corpus"]

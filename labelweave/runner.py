"""Run one corpus plan, or many."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .plans import Corpus, get_corpus
from .sinks import read_dataset, store_manifest, store_sample, write_dataset

logger = logging.getLogger(__name__)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

# Raw input of a corpus: the folder of its files, or its raw frames.
Source = str | Mapping[str, DataFrame]


def build(spark: SparkSession, name: str, source: Source, **options: object) -> DataFrame:
    """The wide frame of a corpus, nothing written."""
    corpus = get_corpus(name)
    raws = corpus.read(spark, source) if isinstance(source, str) else dict(source)
    return corpus.build(raws, **options)


def _documentation(corpus: Corpus) -> dict[str, object]:
    info = asdict(corpus.info)
    info["labels"] = list(info["labels"])
    return {"dataset": corpus.name, **info}


def run_one(
    spark: SparkSession,
    name: str,
    source: Source,
    data_dir: str,
    overwrite: bool = False,
    num_shards: int | None = None,
    max_shard_size: int | str | None = "500MB",
    storage_options: Mapping[str, str] | None = None,
    seed: int = 0,
    options: Mapping[str, object] | None = None,
) -> int:
    """Read, build and write one corpus; returns its number of rows.

    The dataset goes to ``data_dir/<name>`` with its documentation. Its entries
    in the manifest and in the samples are replaced.
    """
    corpus = get_corpus(name)
    folder = f"{data_dir}/{corpus.name}"
    wide = build(spark, corpus.name, source, **(options or {}))
    write_dataset(
        wide,
        folder,
        overwrite=overwrite,
        num_shards=num_shards,
        max_shard_size=max_shard_size,
        info=_documentation(corpus),
        storage_options=storage_options,
        order_by=corpus.order_by,
    )
    written = read_dataset(spark, folder)
    store_manifest(spark, data_dir, corpus.name)
    store_sample(spark, data_dir, corpus.name, seed)
    return written.count()


def run_many(
    spark: SparkSession,
    sources: Mapping[str, Source],
    data_dir: str,
    skip: Iterable[str] = (),
    skip_errors: bool = True,
    **run_options: object,
) -> DataFrame:
    """Run several corpora one after another and report on each.

    All names are checked before the first one runs. A failing corpus is logged
    and reported, or raised when ``skip_errors`` is off.
    """
    left_out = {get_corpus(n).name for n in skip}
    todo = {get_corpus(n).name: source for n, source in sources.items()}
    report: list[tuple[str, str, int | None, str | None]] = []
    for name, source in todo.items():
        if name in left_out:
            report.append((name, "skipped", None, None))
            continue
        try:
            report.append((name, "done", run_one(spark, name, source, data_dir, **run_options), None))
        except Exception as error:
            if not skip_errors:
                raise RuntimeError(f"could not process {name}: {error}") from error
            logger.critical("could not process %s: %s", name, error)
            report.append((name, "failed", None, str(error).splitlines()[0]))
    logger.info("report: %s", json.dumps(report))
    return spark.createDataFrame(report, REPORT_SCHEMA)

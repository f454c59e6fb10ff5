"""Sinks, dataset reports and batch runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans import catalog, get_corpus
from ..plans.base import CORPORA
from ..runner import run_many, run_one
from ..sinks import (
    TargetNotEmpty,
    dataset_profile,
    file_stats,
    merge_manifest,
    read_dataset,
    row_counts,
    sample_one,
    write_dataset,
)
from .base import query, sql_text, staging, table
from .corpora import TEC_SQL, carer_raws, crowdflower_raws, emobank_raws, tec_raws, usvsthem_raws


@query(
    "row_count",
    "SELECT 'documents' AS dataset, COUNT(*) AS n_rows FROM documents UNION ALL "
    "SELECT 'labels', COUNT(*) FROM labels UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem",
)
def row_count(spark, sf_dir):
    return row_counts({n: table(spark, sf_dir, n) for n in ("documents", "labels", "lineitem")})


@query(
    "dataset_profile",
    "SELECT source, COUNT(*) AS size, COUNT(DISTINCT lang) AS labels, COUNT(DISTINCT lang) > 1 "
    "AS multilabel FROM documents GROUP BY source",
)
def dataset_profile_(spark, sf_dir):
    return dataset_profile(table(spark, sf_dir, "documents"), ["source"], "lang")


@query("write_sharded", "SELECT 4 AS n_files, COUNT(*) AS n_rows FROM documents")
def write_sharded(spark, sf_dir):
    path = staging(spark)
    write_dataset(table(spark, sf_dir, "documents"), path, num_shards=4)
    files = F.countDistinct("_metadata.file_path").cast("int").alias("n_files")
    return read_dataset(spark, path).agg(files, F.count(F.lit(1)).alias("n_rows"))


@query(
    "write_guard",
    "SELECT 'first' AS step, 'written' AS outcome, COUNT(*) AS n_rows FROM labels UNION ALL "
    "SELECT 'second', 'refused', COUNT(*) FROM labels UNION ALL "
    "SELECT 'overwrite', 'written', COUNT(*) FROM conversations",
)
def write_guard(spark, sf_dir):
    base = staging(spark)

    def step(name, source, folder, overwrite):
        try:
            write_dataset(table(spark, sf_dir, source), f"{base}/{folder}", overwrite=overwrite)
            outcome = "written"
        except TargetNotEmpty:
            outcome = "refused"
        left = read_dataset(spark, f"{base}/{folder}").agg(F.count(F.lit(1)).alias("n_rows"))
        return left.select(F.lit(name).alias("step"), F.lit(outcome).alias("outcome"), "n_rows")

    write_dataset(table(spark, sf_dir, "labels"), f"{base}/replaced")
    steps = [
        step("first", "labels", "kept", False),
        step("second", "conversations", "kept", False),
        step("overwrite", "conversations", "replaced", True),
    ]
    return reduce(lambda a, b: a.union(b), steps)


def _catalog_sql() -> str:
    sizes = {
        "CARER": "(SELECT COUNT(*) FROM documents) + (SELECT COUNT(*) FROM conversations) "
        "+ (SELECT COUNT(*) FROM benchmark)",
        "EmoBank": "(SELECT COUNT(*) FROM labels)",
        "UsVsThem": "(SELECT COUNT(*) FROM documents)",
    }
    rows = []
    for name in CORPORA:
        info = get_corpus(name).info
        rows.append(
            f"SELECT {sql_text(name)} AS dataset, {len(info.labels)} AS n_labels, "
            f"{str(info.multilabel).lower()} AS multilabel, {str(info.continuous).lower()} AS continuous, "
            f"CAST({sizes.get(name, 'NULL')} AS BIGINT) AS size"
        )
    return " UNION ALL ".join(rows)


@query("dataset_catalog", _catalog_sql())
def dataset_catalog(spark, sf_dir):
    """Documentation of all corpora, and the size of those built from the tables here."""
    raws = {"CARER": carer_raws, "EmoBank": emobank_raws, "UsVsThem": usvsthem_raws}
    sizes = row_counts({n: get_corpus(n).build(f(spark, sf_dir)) for n, f in raws.items()})
    return (
        catalog(spark)
        .join(sizes, "dataset", "left")
        .select(
            "dataset",
            F.size("emotions").alias("n_labels"),
            "multilabel",
            "continuous",
            F.col("n_rows").alias("size"),
        )
    )


@query(
    "dataset_manifest",
    "SELECT dataset, n_rows, true AS in_order, true AS placed, true AS sized FROM "
    "(SELECT 'texts' AS dataset, COUNT(*) AS n_rows FROM documents UNION ALL "
    "SELECT 'turns', COUNT(*) FROM conversations)",
)
def dataset_manifest(spark, sf_dir):
    """The manifest after the files of one of two datasets were replaced: per dataset the
    rows in the files it lists, and whether entries are in order, named and sized right."""
    base = staging(spark)

    def entry(dataset, source, folder):
        write_dataset(table(spark, sf_dir, source), f"{base}/{folder}/{dataset}", overwrite=True)
        stats = file_stats(spark, f"{base}/{folder}/{dataset}", f"{base}/{folder}")
        return stats.withColumn("dataset", F.lit(dataset)).withColumn("round", F.lit(folder))

    old = entry("texts", "documents", "first").unionByName(entry("turns", "labels", "first"))
    old.write.parquet(f"{base}/old")
    entry("turns", "conversations", "second").write.parquet(f"{base}/new")
    merged = merge_manifest(read_dataset(spark, f"{base}/old"), read_dataset(spark, f"{base}/new"))
    listed = merged.withColumn("at", F.monotonically_increasing_id())
    earlier = F.lag("dataset").over(Window.orderBy("at"))
    listed = listed.withColumn("sorted", F.coalesce(earlier <= F.col("dataset"), F.lit(True)))
    rows = reduce(
        DataFrame.union,
        [
            read_dataset(spark, f"{base}/{folder}/{dataset}").select(
                F.lit(folder).alias("round"), F.lit(dataset).alias("dataset"), F.col("_metadata.file_name").alias("name")
            )
            for folder, dataset in (("first", "texts"), ("first", "turns"), ("second", "turns"))
        ],
    )
    counts = rows.groupBy("round", "dataset", "name").agg(F.count(F.lit(1)).alias("n_rows"))
    placed = F.col("file_path") == F.concat_ws("/", "dataset", "name")
    return (
        listed.join(counts, ["round", "dataset", "name"], "left")
        .groupBy("dataset")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.bool_and("sorted").alias("in_order"),
            F.bool_and(placed).alias("placed"),
            F.bool_and(F.col("file_size") > 0).alias("sized"),
        )
    )


@query(
    "sample_one_per_dataset",
    "SELECT * FROM (SELECT 'documents' AS dataset, doc_id AS id, text FROM documents "
    "ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 1) UNION ALL "
    "SELECT * FROM (SELECT 'benchmark', item_id, text FROM benchmark "
    "ORDER BY md5('7:' || CAST(item_id AS VARCHAR)), item_id LIMIT 1)",
)
def sample_one_per_dataset(spark, sf_dir):
    keys = {"documents": "doc_id", "benchmark": "item_id"}
    draw = F.md5(F.concat(F.lit("7:"), F.col("id").cast("string")))
    picked = [
        sample_one(table(spark, sf_dir, n).select(F.col(k).alias("id"), "text"), ["id"], draw=draw)
        .select(F.lit(n).alias("dataset"), "id", "text")
        for n, k in keys.items()
    ]
    return reduce(lambda a, b: a.union(b), picked)


@query(
    "run_one",
    "SELECT anger, joy, sadness, COUNT(*) AS n FROM ("
    + TEC_SQL
    + ") GROUP BY anger, joy, sadness",
)
def run_one_(spark, sf_dir):
    raws = tec_raws(spark, sf_dir)
    base = staging(spark)
    run_one(spark, "TEC", raws, base)
    flags = [F.col(n) for n in ("anger", "joy", "sadness")]
    return read_dataset(spark, f"{base}/TEC").groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


@query(
    "run_many_report",
    "SELECT 'CARER' AS dataset, 'done' AS status, (SELECT COUNT(*) FROM documents) + (SELECT COUNT(*) "
    "FROM conversations) + (SELECT COUNT(*) FROM benchmark) AS n_rows, false AS has_error UNION ALL "
    "SELECT 'CrowdFlower', 'done', COUNT(*), false FROM (SELECT DISTINCT user_id, event_type "
    "FROM events) UNION ALL SELECT 'EmoBank', 'failed', NULL, true UNION ALL "
    "SELECT 'UsVsThem', 'skipped', NULL, false",
)
def run_many_report(spark, sf_dir):
    sources = {
        "CARER": carer_raws(spark, sf_dir),
        "CrowdFlower": crowdflower_raws(spark, sf_dir),
        # Half of its input is missing, so this one must be reported as failed.
        "EmoBank": {"data": emobank_raws(spark, sf_dir)["data"]},
        "UsVsThem": usvsthem_raws(spark, sf_dir),
    }
    report = run_many(spark, sources, staging(spark), skip=["UsVsThem"])
    return report.select(
        "dataset", "status", "n_rows", F.col("error").isNotNull().alias("has_error")
    )

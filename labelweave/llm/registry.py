"""The operators as queries over the test tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import (
    anchors,
    conversations,
    decontamination,
    minhash,
    mixing,
    neighbours,
    pages,
    periods,
    phrases,
    secrets,
    sharding,
    suffixes,
    toxicity,
)
from .frames import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mixing": lambda spark, sf: mixing.op1(documents(spark, sf)),
    "op2_anchor_dedup": lambda spark, sf: anchors.op2(documents(spark, sf)),
    "op3_gated_toxicity": lambda spark, sf: toxicity.op3(
        documents(spark, sf), table(spark, sf, "labels")
    ),
    "op4_tree_extraction": lambda spark, sf: pages.op4(table(spark, sf, "pages")),
    "op5_sparse_suffixes": lambda spark, sf: suffixes.op5(documents(spark, sf)),
    "op6_neighbour_descent": lambda spark, sf: neighbours.op6(table(spark, sf, "embeddings")),
    "op7_secret_scan": lambda spark, sf: secrets.op7(documents(spark, sf)),
    "op8_latent_decontamination": lambda spark, sf: decontamination.op8(
        documents(spark, sf), table(spark, sf, "benchmark")
    ),
    "op9_minhash_near_dedup": lambda spark, sf: minhash.op9(documents(spark, sf)),
    "op10_jump_sharding": lambda spark, sf: sharding.op10(documents(spark, sf)),
    "op11_checkpointed_repair": lambda spark, sf: conversations.op11(table(spark, sf, "conversations")),
    "op12_phrase_fingerprints": lambda spark, sf: phrases.op12(documents(spark, sf)),
    "op13_recompressed_runs": lambda spark, sf: periods.op13(documents(spark, sf)),
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_pareto_mixing": mixing.OP1_SQL,
    "op2_anchor_dedup": anchors.OP2_SQL,
    "op5_sparse_suffixes": suffixes.OP5_SQL,
    "op7_secret_scan": secrets.OP7_SQL,
    "op9_minhash_near_dedup": minhash.OP9_SQL,
    "op11_checkpointed_repair": conversations.OP11_SQL,
    "op13_recompressed_runs": periods.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

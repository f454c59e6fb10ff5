"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import frozen


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the least of its neighbours and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("u", "m").alias("m")
    )
    near = both.join(least, F.col("u") == F.col("c")).filter("v > u")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the least of them; edges point down."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
    near = edges.join(least, F.col("u") == F.col("c"))
    ends = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select(F.col("c").alias("u"), F.col("m").alias("v"))
    )
    return ends.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the least node it is tied to, of every linked node.

    ``links`` has columns u and v of one orderable type. Only counts and sums reach the
    driver; a node with very many links is one row per task before each shuffle.
    """
    edges = frozen(
        links.filter("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    mark = None
    while True:
        # Order-free digest of the edges: equal when a round changed nothing.
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        now = tuple(edges.agg(F.count(F.lit(1)), digest).first())
        if now == mark or not now[0]:
            break
        mark = now
        edges = frozen(_small_star(_large_star(edges)), "stars")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("comp"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)

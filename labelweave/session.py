"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the library is tuned for. A session made elsewhere works too: no
# result depends on them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(
    app_name: str = "labelweave", master: str | None = None, **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh place that every executor can reach, for files of this session.

    It lies below ``spark.checkpoint.dir``, or below the session's warehouse, which
    executors share as well, where that setting is absent. Nothing is there yet; what is
    written is removed when the driver's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/working"
    folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only what exists can be marked, so the place is one level below.
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/files"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))

"""Session settings and the scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


# HotSpot never compiles methods over 8000 bytes. The wide staging projections exceed that in one whole-stage method and
# would run interpreted; with the limit known to Spark it generates them in smaller pieces (about twice as fast).
# Layer tables are compressed some ten times smaller than their rows are in an aggregation or a sort, so a task with Spark's
# 128 MB of a table, or its 64 MB of a shuffle, would spill.
RUNTIME_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def build_session(app: str = "tillworks", **conf: str) -> SparkSession:
    """A session with the settings the library expects; keyword arguments override (dots written as ``__``).

    On a cluster set ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` to the largest shuffle divided by
    about 128 MB: AQE merges small shuffle partitions by itself but starts from that number.
    """
    settings = RUNTIME_SETTINGS | {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillworks-"))
    return context.getCheckpointDir()

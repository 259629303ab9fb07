"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tillworks.session import shared_folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Each application has a folder of its own, to be deleted after it."""
    return f"{shared_folder(spark)}/tillworks-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write a table and read it back: later jobs neither recompute it nor depend on the executors that made it.

    Its size is then known, so that Spark broadcasts it in a join only if it is below the session's threshold. The path is
    added to ``paths``, for ``discard``.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that no later job reads."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the bare path of a folder given as a URI or a plain path. Works inside tasks."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")

"""Parquet tables in the cluster's shared folder: durable cut points between jobs.

A frame that is read by more than one job is written once and read back. Unlike cached blocks the
files outlive lost executors, and unlike a recomputed plan they keep partition borders stable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Spark deletes a query's shuffle files when the query ends if this is set, else when the driver
# happens to collect garbage, which on large tables may be never.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# What to forget when the staged files go: holders of frames that read them.
_on_release: list[Callable[[], None]] = []


def shared_root(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir, or where that is unset below the
    warehouse folder, which all executors reach as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/orderloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# Paths staged inside `temporary`, None outside.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files as they end."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, so no frame that reads it may leave."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            delete_folder(spark, path)


def stage(frame: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write the frame once and continue from the files; by default in the session's compression."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    with shuffles_dropped(spark):
        frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(configuration).delete(target, True)


def when_released(forget: Callable[[], None]) -> None:
    """Call `forget` whenever staged files are deleted."""
    _on_release.append(forget)


def release(spark: SparkSession) -> None:
    """Delete everything this application staged; frames made before cannot be read any more."""
    delete_folder(spark, shared_root(spark))
    for forget in _on_release:
        forget()

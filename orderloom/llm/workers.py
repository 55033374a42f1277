"""This package on Python workers that were started without it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let Spark hand the package's sources to every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent.parent
    folder = os.path.realpath(tempfile.mkdtemp(prefix="orderloom-sources-"))
    path = os.path.join(folder, "orderloom_sources.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(path)
    _sent.add(context.applicationId)


def in_arrow(frame: DataFrame, function, schema: str | StructType) -> DataFrame:
    """mapInArrow with this package at hand."""
    send_package(frame.sparkSession)
    return frame.mapInArrow(function, schema)


_kept: dict[tuple, object] = {}


def keep_one(key: tuple, make: Callable[[], object]):
    """What `make` gives, kept in this Python worker until another key is asked for.

    Workers serve one operator after another; what the last one prepared must not fill memory beside
    the next one's.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]

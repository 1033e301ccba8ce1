"""Let the workers import the package, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

import millrace

_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@lru_cache(maxsize=8)
def _ship(application: str) -> None:
    root = os.path.dirname(os.path.abspath(millrace.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    SparkSession.active().sparkContext.addPyFile(archive)


def ship(spark: SparkSession) -> None:
    """Send the package's source to the workers, once an application."""
    _ship(spark.sparkContext.applicationId)


def set_arrow_batches(spark: SparkSession, size: int) -> None:
    """From now on, hand the workers Arrow batches of at most ``size`` bytes, or of one row.

    For steps that return a table which the caller runs later, when a context has ended.
    """
    spark.conf.set(_ARROW_BYTES, size)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """While a job runs, hand the workers Arrow batches of at most ``size`` bytes, or of one row."""
    before = spark.conf.get(_ARROW_BYTES)
    set_arrow_batches(spark, size)
    try:
        yield
    finally:
        spark.conf.set(_ARROW_BYTES, before)

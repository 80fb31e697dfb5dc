"""Python workers: of a checkout that is not installed, and what they hold between tasks."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

Batches = Iterator[pa.RecordBatch]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from the checkout."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def release() -> None:
    """Give memory that is no longer used back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # no such call in this C library


def per_task(convert: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function over Arrow batches that leaves nothing behind when its partition ends.

    Spark keeps workers for later tasks, of other stages too: what one task remembered, such
    as words, must not stay in memory that the next ones need.
    """

    @wraps(convert)
    def run(batches: Batches) -> Batches:
        try:
            yield from convert(batches)
        finally:
            release()

    return run

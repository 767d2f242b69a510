"""What Python workers need: this package, and only the memory of the task at hand."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

Batches = Iterator[pa.RecordBatch]


def known_to_workers(spark: SparkSession) -> None:
    """Let workers import the package from where the driver did.

    That is all a local session needs. On a cluster the package is installed on
    the executors or sent along with ``--py-files``; the path then does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def lean(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` for ``mapInArrow``, handing freed memory back to the system when its task ends.

    Workers are used again by later tasks and stages. What an allocator keeps of
    the arrays of one task would otherwise stay beside the arrays of the next.
    """

    def run(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Return unused memory of Arrow's pool and of the C heap, where the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass

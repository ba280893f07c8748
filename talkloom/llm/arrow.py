"""Run a function over Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_partitions(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply ``function`` to the batches of every partition, then give memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def map_batches(
    df: DataFrame, function: Callable[..., Iterator[pa.RecordBatch]], schema: str, start=None
) -> DataFrame:
    """Apply ``function`` to every batch; batches stay bounded by Spark's setting.

    ``start`` makes what a task needs once; it is handed to ``function`` as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = (start(),) if start else ()
        for batch in batches:
            if batch.num_rows:
                yield from function(batch, *extra)

    return map_partitions(df, run, schema)

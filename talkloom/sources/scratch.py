"""Intermediate tables, written once and read many times.

They lie in the shared folder that ``spark.checkpoint.dir`` names, so they
outlive any executor; like checkpoints they are left to that folder's upkeep.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# What is read again is the table, so no shuffle behind it is needed. Batches for Python
# hold whole texts; fewer at once need less memory.
WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
_SETTING = "spark.checkpoint.dir"
_default: str | None = None


def use_when_unset(path: str) -> None:
    """Name the folder for local sessions that name none themselves."""
    global _default
    _default = path


def scratch_dir(spark: SparkSession) -> str:
    """The folder the session names, or for a local session the one set for this process."""
    named = spark.conf.get(_SETTING, None)
    master = spark.sparkContext.master
    if named is None and (master == "local" or master.startswith("local[")):
        named = _default
    if named is None:
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return named.rstrip("/")


@contextmanager
def with_small_batches(spark: SparkSession) -> Iterator[None]:
    """The session with ``WHILE_WRITING``, then as it was; also for actions that write nothing."""
    before = {name: spark.conf.get(name, None) for name in WHILE_WRITING}
    for name, value in WHILE_WRITING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table and return the table.

    Readers of the table plan from its size and fetch only their columns. The shuffles
    that made it are removed once it is written.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid4().hex}"
    with with_small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

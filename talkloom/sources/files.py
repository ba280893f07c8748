"""Reading the input tables and reading or writing named collections.

A collection in files is a folder of versions. A write goes to a new version and then
adds a pointer to it, a file whose name says which; readers take the latest pointer. So a
write that fails halfway, or has not ended, leaves the collection as it was.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkloom import schemas

# File stem and contract of each input table.
DATASETS = {
    "talks": ("final_list", schemas.TALKS),
    "details": ("details", schemas.DETAILS),
    "tags": ("tags", schemas.TAGS),
    "images": ("images", schemas.IMAGES),
    "related": ("related_videos", schemas.RELATED),
}

# Formats that are folders of files, and where the pointers to their versions lie.
_FILES = ("parquet", "orc", "json", "csv", "avro")
_POINTERS = "_current"
BUCKETS = 64


@dataclass(frozen=True)
class Catalog:
    """The five input tables."""

    talks: DataFrame
    details: DataFrame
    tags: DataFrame
    images: DataFrame
    related: DataFrame


def dataset_path(base: str, table: str, fmt: str = "csv") -> str:
    """Where a dataset's file lies under any Hadoop-visible base."""
    return f"{base.rstrip('/')}/{DATASETS[table][0]}.{fmt}"


def read_dataset(
    spark: SparkSession, base: str, table: str, fmt: str = "csv", quoted_newlines: bool = False
) -> DataFrame:
    """One input table, every CSV column a string, extra columns passed through.

    Names come from the header, so no type inference pass over the data runs.
    Doubled quotes inside quoted fields are read as one. ``quoted_newlines`` accepts
    line breaks in them; such a file cannot be split, so keep it off for large files.
    """
    path = dataset_path(base, table, fmt)
    if fmt == "csv":
        reader = spark.read.option("header", True).option("escape", '"')
        df = reader.option("multiLine", quoted_newlines).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
        ids = [c for c in ("id", "related_id") if c in df.columns]
        df = df.withColumns({c: F.col(c).cast("string") for c in ids})
    return schemas.require(df, DATASETS[table][1], table)


def read_catalog(
    spark: SparkSession, base: str, fmt: str = "csv", quoted_newlines: bool = False
) -> Catalog:
    """All five input tables."""
    return Catalog(**{t: read_dataset(spark, base, t, fmt, quoted_newlines) for t in DATASETS})


def _folder(spark: SparkSession, path: str):
    """A path and the file system it is on, as Hadoop sees them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _pointers(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and folder of each version that was written to its end, oldest first."""
    files, where = _folder(spark, f"{root}/{_POINTERS}")
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    found = (name.split("-", 1) for name in names if name[:1].isdigit())
    return sorted((int(number), f"{root}/{folder}") for number, folder in found)


def read_collection(
    spark: SparkSession,
    base: str,
    name: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A named collection, its latest version; filters and projections on it reach the scan."""
    reader = spark.read.format(fmt).options(**(options or {}))
    root = f"{base.rstrip('/')}/{name}"
    versions = _pointers(spark, root) if fmt in _FILES else []
    return reader.load(versions[-1][1] if versions else root)


def write_collection(
    df: DataFrame,
    base: str,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    key: str | None = None,
    seen: Observation | None = None,
) -> None:
    """Write a named collection; overwriting makes a rerun idempotent.

    In file formats an overwrite is a new version that readers see once it is whole; the
    version before stays for those who read it, older ones go. With ``key`` the rows
    are clustered by it, see :func:`clustered`. ``seen`` is given the count of rows.
    """
    spark = df.sparkSession
    root = f"{base.rstrip('/')}/{name}"
    options = dict(options or {})
    if key is not None:
        df, options = clustered(df, key), _bloom(key) | options
    if seen is not None:
        # after the rows are clustered, as sorting reads them more than once
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = df.write.format(fmt).mode(mode).options(**options)
    if fmt not in _FILES:
        writer.save(root)
        return
    versions = _pointers(spark, root)
    if mode != "overwrite":
        writer.save(versions[-1][1] if versions else root)
        return
    folder = f"version-{uuid4().hex}"
    files, half = _folder(spark, f"{root}/{folder}")
    try:
        writer.save(f"{root}/{folder}")
    except BaseException:
        files.delete(half, True)
        raise
    number = versions[-1][0] + 1 if versions else 1
    files, pointer = _folder(spark, f"{root}/{_POINTERS}/{number:09d}-{folder}")
    # of two writers at once the second fails, instead of hiding what the first wrote
    if any(int(n) == number for n, _ in _pointers(spark, root)):
        raise FileExistsError(f"{root} was written by another job at the same time")
    files.create(pointer, False).close()
    for old, path in versions[:-1]:
        files.delete(_folder(spark, path)[1], True)
        gone = path.rsplit("/", 1)[1]
        files.delete(_folder(spark, f"{root}/{_POINTERS}/{old:09d}-{gone}")[1], False)


def clustered(df: DataFrame, key: str) -> DataFrame:
    """``df`` sorted by ``key`` over all files, so that a lookup skips most of them."""
    return df.repartitionByRange(key).sortWithinPartitions(key)


def _bloom(key: str) -> dict[str, str]:
    """Parquet options for lookups by ``key``: a Bloom filter of it and small row groups."""
    return {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.block.size": str(16 << 20)}


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` under ``path`` in a fixed number of buckets by ``key``, as table ``table``.

    Joins on ``key`` between tables with equal buckets, or with rows brought to their
    buckets, leave the stored rows where they are.
    """
    dealt = df.repartition(buckets, key)
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)

"""Column contracts of the input tables.

Ids are strings everywhere: they are compared, sorted and looked up as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


TALKS = _strings("id", "slug", "speakers", "title", "url")
DETAILS = _strings("id", "description", "duration", "publishedAt")
TAGS = _strings("id", "tag")
IMAGES = _strings("id")
RELATED = _strings("id", "related_id")


def require(df: DataFrame, contract: T.StructType, table: str) -> DataFrame:
    """Return ``df`` unchanged, or fail if it lacks a column of the contract."""
    missing = [n for n in contract.names if n not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}, found {df.columns}")
    return df

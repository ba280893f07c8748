"""Vectors of whole numbers, packed as bytes, with exact inner products."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.arrow import map_batches


def packed(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as bytes, 32 bits a number."""
    matrix = np.ascontiguousarray(matrix, dtype="<i4")
    width = matrix.shape[1] * 4
    offsets = pa.py_buffer(np.arange(len(matrix) + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, offsets, pa.py_buffer(matrix)])


def unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The matrix whose rows were packed."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<i4").reshape(len(rows), -1)


def product_type(a: np.ndarray, b: np.ndarray) -> type:
    """A type in which inner products of rows of ``a`` and ``b`` are exact, doubles if possible."""
    largest = (int(np.abs(m).max(initial=0)) for m in (a.astype(np.int64), b.astype(np.int64)))
    bound = a.shape[1]
    for one in largest:
        bound *= one
    return np.float64 if bound < 1 << 53 else np.int64


def integer_vectors(
    vectors: DataFrame, key: str, vector: str, scale: int = 256, label: Column | None = None
) -> DataFrame:
    """id, label and v (packed): floor(scale * component) of the vectors that take part.

    No part take vectors that are null, empty, hold null or non-finite components or are
    not as long as most (ties: the shorter length), rows without an id, with ``label``
    those without a label, and vectors with a component so large that a score could
    leave 64 bits (2^31 / sqrt(length) after scaling, 2^28 at 64 components). Rows of one
    id are one row: the one with the smallest label, then vector.
    """
    own = [F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x")]
    rows = vectors.select(*own, (F.lit(0) if label is None else label).cast("bigint").alias("label"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0))
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    most = sizes.first()
    width = most["n"] if most else 0
    limit = min(isqrt((1 << 62) // max(1, width)), (1 << 31) - 1)
    whole = F.transform("x", lambda c: F.floor(c * scale))
    rows = rows.where(F.size("x") == width).select("id", "label", whole.alias("v"))
    rows = rows.where(F.forall("v", lambda c: (c >= -limit) & (c <= limit)))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        matrix = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        columns = [batch.column(0), batch.column(1), packed(matrix)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "label", "v"])

    return map_batches(rows.select("id", "row.label", "row.v"), run, "id bigint, label bigint, v binary")


def pieces(count: int, size: int) -> int:
    """How many pieces of about ``size`` rows a table of ``count`` rows is cut into."""
    return max(1, -(-count // size))

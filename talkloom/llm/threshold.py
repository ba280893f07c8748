"""Exact top-k by inner product with the threshold algorithm over sorted lists.

Rows are dealt to blocks of about ``BLOCK_ROWS`` by a hash of their id. Each block has a
list for every dimension, its rows in the order of their value there; the lists are
stored. For a query the lists of all dimensions are read side by side, from the end
where the query's product is largest. Every row met is scored in full (random access).
The sum of the products at the places reached bounds the score of all rows not met yet;
reading stops when it is below the k-th best score, as then nothing can enter the result,
not even a tie with a smaller id.

Each query first visits one block, its home. The k-th best score there is a floor for
all other blocks: their lists are read until the bound is below it, and not at all where
the largest products already are. Only rows that reach the floor are returned and merged.

Queries meet blocks in chunks of at most ``QUERY_CHUNK``, so a task holds one block's
lists and one chunk. Nothing is collected but counts. Which vectors take part is said in
:func:`talkloom.llm.integers.integer_vectors`; copies of a vector under several ids are
rows of their own. A row is never in its own result. An empty table gives an empty result.
Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.arrow import give_back
from talkloom.llm.integers import integer_vectors, packed, pieces, product_type, unpacked

BLOCK_ROWS = 4_096
QUERY_CHUNK = 1_024
FIRST_DEPTH = 16


@dataclass
class Lists:
    """A block's rows by id, and for each dimension its rows in the order of their values."""

    ids: np.ndarray
    rows: np.ndarray  # a row's numbers, for random access
    order: np.ndarray  # dimensions x rows: places in ``ids``
    values: np.ndarray  # dimensions x rows, ascending


def threshold_top(
    lists: Lists, query: np.ndarray, own: int, k: int, floor: int | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the best rows that reach ``floor``, and how many rows were scored.

    Ties go to smaller ids; the row with id ``own`` is left out.
    """
    n = len(lists.ids)
    used = query != 0 if query.any() else np.ones(len(query), dtype=bool)
    up, down = np.flatnonzero(used & (query >= 0)), np.flatnonzero(used & (query < 0))
    least = -np.inf if floor is None else floor
    places, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=query.dtype)
    if not n or query[up] @ lists.values[up, -1] + query[down] @ lists.values[down, 0] < least:
        return lists.ids[places], scores, 0
    seen = np.zeros(n, dtype=bool)
    scored = depth = 0
    step = FIRST_DEPTH
    while depth < n:
        before, depth = depth, min(n, depth + step)
        met = np.zeros(n, dtype=bool)
        met[lists.order[up, n - depth : n - before]] = True
        met[lists.order[down, before:depth]] = True
        fresh = np.flatnonzero(met & ~seen)
        seen[fresh] = True
        scored += len(fresh)
        found = lists.rows[fresh] @ query
        fit = (found >= least) & (lists.ids[fresh] != own)
        places = np.concatenate((places, fresh[fit]))
        scores = np.concatenate((scores, found[fit]))
        best = np.lexsort((places, -scores))[:k]  # places are in the order of ids
        places, scores = places[best], scores[best]
        if len(scores) == k:
            least = max(least, scores[-1])
        bound = query[up] @ lists.values[up, n - depth] + query[down] @ lists.values[down, depth - 1]
        if bound < least or scored == n:
            break
        step *= 2
    return lists.ids[places], scores, scored


def sorted_lists(rows: DataFrame, blocks: int) -> DataFrame:
    """block, dim, order and numbers: a row for each dimension of each block.

    The row of dim -1 holds the block's ids and its vectors instead.
    """

    def build(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        ids = table.column("id").to_numpy()
        by_id = np.argsort(ids)
        matrix = unpacked(table.column("v"))[by_id]
        order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
        values = np.take_along_axis(matrix.T, order, axis=1)
        dims = len(order)
        whole = [ids[by_id].astype("<i8").tobytes(), *(row.tobytes() for row in order)]
        numbers = [matrix.tobytes(), *packed(values).to_pylist()]
        columns = [
            pa.array([block] * (dims + 1), pa.int32()),
            pa.array(range(-1, dims), pa.int32()),
            pa.array(whole, pa.binary()),
            pa.array(numbers, pa.binary()),
        ]
        return pa.Table.from_arrays(columns, ["block", "dim", "places", "numbers"])

    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    schema = "block int, dim int, places binary, numbers binary"
    return rows.select("id", "v", block).groupBy("block").applyInArrow(build, schema)


def _lists_of(table: pa.Table) -> Lists:
    table = table.sort_by("dim")
    places, numbers = table.column("places").to_pylist(), table.column("numbers").to_pylist()
    ids = np.frombuffer(places[0], dtype="<i8")
    rows = np.frombuffer(numbers[0], dtype="<i4").reshape(len(ids), -1)
    order = np.frombuffer(b"".join(places[1:]), dtype="<i4").reshape(-1, len(ids))
    values = np.frombuffer(b"".join(numbers[1:]), dtype="<i4").reshape(-1, len(ids))
    return Lists(ids, rows, order, values)


def _visit(lists: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, id and score of the best rows of each block for each query sent there.

    ``lists`` has block and chunk besides its columns, ``asked`` block, chunk, id, v and floor.
    """

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            found = _lists_of(left)
            queries = unpacked(right.column("v"))
            kind = product_type(found.rows, queries)
            found = Lists(found.ids, found.rows.astype(kind), found.order, found.values.astype(kind))
            floors = right.column("floor").to_pylist()
            for own, query, floor in zip(right.column("id").to_pylist(), queries.astype(kind), floors):
                ids, scores, _ = threshold_top(found, query, own, k, floor)
                for column, values in zip(out, (np.full(len(ids), own), ids, scores)):
                    column.append(values.astype(np.int64))
        empty = np.zeros(0, dtype=np.int64)
        columns = [pa.array(np.concatenate([empty, *column])) for column in out]
        give_back()
        return pa.Table.from_arrays(columns, ["query_id", "id", "score"])

    asked = asked.select("block", "chunk", "id", "v", "floor")
    grouped = lists.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk"))
    return grouped.applyInArrow(search, "query_id bigint, id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    store: Callable[[DataFrame, str], DataFrame],
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """query_id, rank (from 1), the key and score: the ``k`` best rows for each query.

    ``is_query`` is a condition on the column ``id``. Scores are inner products of
    floor(scale * component). All candidates come, if there are fewer than ``k``.
    """
    rows = store(integer_vectors(vectors, key, vector, scale).select("id", "v"), "integer-vectors")
    blocks = pieces(rows.count(), BLOCK_ROWS)
    queries = rows.where(is_query)
    chunks = pieces(queries.count(), QUERY_CHUNK)
    chunk = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk")
    queries = queries.select("id", "v", chunk)
    lists = store(sorted_lists(rows, blocks), "sorted-lists")

    # the home block gives a floor
    home = F.pmod("chunk", F.lit(blocks)).cast("int")
    at_home = queries.select("*", home.alias("block"), F.lit(None).cast("bigint").alias("floor"))
    homes = rows.sparkSession.range(chunks).select(F.col("id").cast("int").alias("chunk"))
    homes = homes.select("chunk", home.alias("block"))
    first = store(_visit(lists.join(homes, "block"), at_home, k), "home-results")
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
    floors = floors.where(F.col("n") >= k).select(F.col("query_id").alias("id"), "floor")
    # all other blocks
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    away = queries.join(floors, "id", "left").select("*", every_block).where(home != F.col("block"))
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    spread = lists.select("*", every_chunk).where(home != F.col("block"))
    found = _best(first.unionByName(_visit(spread, away, k)), k)
    return found.select("query_id", "rank", F.col("id").alias(key), "score")

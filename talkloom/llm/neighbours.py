"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts, a softmax
classifier learns to tell a vector's part from the vector, and then routes every
vector to one partition and every query to the several most probable ones, where
all vectors are reranked by the exact inner product in double precision. How many
partitions a query visits is the smallest number that finds ``recall`` of the true
neighbours of held-out sample rows.

Equal vectors are one entry of the index with their smallest ids, no more than a
result can use, so a vector that very many rows share is no hot spot; the rows
are cut map-side before they are shuffled. Partitions are cut into blocks of
bounded size, so no task holds a whole partition.

Vectors that are null, zero, hold null or non-finite components, or are not as
long as most vectors take no part. Rows of one id are one row, that of the smallest vector. Ties go to the smaller
id. An empty table gives an empty result. Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 8_192
HELD_OUT = 512
GRAPH_DEGREE = 12
BLOCK_ROWS = 16_384
QUERY_CHUNK = 1_024


@dataclass
class Router:
    """A linear softmax classifier of vectors into partitions."""

    weight: np.ndarray
    bias: np.ndarray
    visits: int

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Partitions of each row, most probable first."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        scores = (x / np.where(norm > 0, norm, 1)) @ self.weight + self.bias
        return np.argsort(-scores, axis=1, kind="stable")


def balanced_parts(x: np.ndarray, links: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """Cut the graph ``links`` (neighbours of each row) into parts of nearly equal size.

    Starts from halvings along the main direction and moves rows to the part that
    most of their neighbours are in, as long as that part has room.
    """
    part = np.zeros(len(x), dtype=np.int64)
    pieces = [(np.arange(len(x)), 0, parts)]
    while pieces:
        rows, first, count = pieces.pop()
        if count == 1 or len(rows) < 2:
            part[rows] = first
            continue
        centred = x[rows] - x[rows].mean(0)
        direction = np.linalg.svd(centred.T @ centred)[0][:, 0]
        order = np.argsort(centred @ direction, kind="stable")
        left = count // 2
        cut = len(rows) * left // count
        pieces.append((rows[order[:cut]], first, left))
        pieces.append((rows[order[cut:]], first + left, count - left))
    room = int(np.ceil(1.1 * len(x) / parts))
    sizes = np.bincount(part, minlength=parts)
    both = [np.concatenate(([i], links[i])) for i in range(len(x))]
    for _ in range(rounds):
        moved = 0
        for i in range(len(x)):
            votes = np.bincount(part[both[i]], minlength=parts)
            votes[sizes >= room] = -1
            best = int(votes.argmax())
            if best != part[i] and votes[best] > np.count_nonzero(part[both[i]] == part[i]):
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < len(x) // 200:
            break
    return part


def train_router(x: np.ndarray, target: np.ndarray, steps: int = 150, rate: float = 0.1) -> Router:
    """Fit the classifier to soft targets (rows sum to 1) by Adam on all rows."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(norm > 0, norm, 1)
    params = np.zeros((x.shape[1] + 1, target.shape[1]))
    first, second = np.zeros_like(params), np.zeros_like(params)
    inputs = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    for step in range(1, steps + 1):
        scores = inputs @ params
        scores = np.exp(scores - scores.max(1, keepdims=True))
        scores /= scores.sum(1, keepdims=True)
        slope = inputs.T @ (scores - target) / len(x) + 1e-5 * params
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Router(params[:-1], params[-1], 1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Key and ``v`` (array of double) of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.where(F.exists(v, lambda c: c != 0.0))
    sizes = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    most = sizes.first()
    rows = rows.where(F.size(v) == (most["n"] if most else 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _distinct(rows: DataFrame, top: int) -> DataFrame:
    """Each distinct vector with its ``top`` smallest ids; the cut also runs before the shuffle."""
    within = Window.partitionBy("v").orderBy("id")
    ranked = rows.withColumn("place", F.dense_rank().over(within)).where(F.col("place") <= top)
    return ranked.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def _neighbour_graph(sample: DataFrame, matrix, degree: int) -> pd.DataFrame:
    """The nearest sample rows of each sample row; at most SAMPLE_ROWS rows of ``degree``."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        everything = matrix.value
        for part in parts:
            for at in range(0, len(part), QUERY_CHUNK):
                rows = part["row"].to_numpy()[at : at + QUERY_CHUNK]
                scores = everything[rows] @ everything.T
                scores[np.arange(len(rows)), rows] = -np.inf
                near = np.argsort(-scores, axis=1, kind="stable")[:, :degree]
                yield pd.DataFrame({"row": rows, "near": list(near.astype(np.int64))})

    return sample.mapInPandas(run, "row bigint, near array<bigint>").toPandas()


def fit_router(rows: DataFrame, count: int, top: int, recall: float, sample_rows: int) -> Router:
    """Fit on at most ``sample_rows`` distinct vectors, chosen by a hash."""
    spark = rows.sparkSession
    chosen = rows.orderBy(F.xxhash64("v"), "v").limit(sample_rows).select("v").toPandas()
    if not len(chosen):
        return Router(np.zeros((0, 1)), np.zeros(1), 1)
    x = np.array(chosen["v"].tolist(), dtype=np.float64)
    parts = int(max(1, min(np.sqrt(count) / 16, len(x) / 64, 1024)))
    if parts <= 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    rng = np.random.default_rng(11)
    held = rng.permutation(len(x))[: min(HELD_OUT, len(x) // 8)]
    kept = np.setdiff1d(np.arange(len(x)), held)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    matrix = spark.sparkContext.broadcast(unit[kept])
    index = spark.range(len(kept)).select(F.col("id").alias("row")).repartition(
        max(1, len(kept) // QUERY_CHUNK)
    )
    graph = _neighbour_graph(index, matrix, GRAPH_DEGREE).sort_values("row")
    links = np.array(graph["near"].tolist())
    part = balanced_parts(unit[kept], links, parts)
    near = np.eye(parts)[part[links]].mean(1)
    router = train_router(unit[kept], 0.5 * np.eye(parts)[part] + 0.5 * near)

    # visits: compare with exact search on the held-out rows
    home = router.ranked(x[kept])[:, 0]
    scores = x[held] @ x[kept].T
    true = np.argsort(-scores, axis=1, kind="stable")[:, : min(top, len(kept))]
    order = router.ranked(x[held])
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(place, home[true], axis=1)
    found = [(needed < v).mean() for v in range(1, parts + 1)]
    router.visits = int(np.argmax(np.array(found) >= recall)) + 1
    return router


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    top: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    recall: float = 0.97,
    sample_rows: int = SAMPLE_ROWS,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """The ``top`` nearest rows of ``vectors`` found for each row of ``queries``.

    Columns: query_id, rank (from 1), the key, score. A row is never its own neighbour.
    ``store`` writes the index's entries, which are read three times.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    entries = _distinct(rows, top + 1)
    if store:
        entries = store(entries, "index-entries")
    count = entries.count()
    router = spark.sparkContext.broadcast(fit_router(entries, count, top, recall, sample_rows))

    def route(parts: Iterator[pd.DataFrame], visits: int) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = np.array(part["v"].tolist(), dtype=np.float64)
            ranked = router.value.ranked(x)[:, :visits].astype(np.int32)
            yield part.assign(parts=list(ranked))

    def home(parts):
        return route(parts, 1)

    def visited(parts):
        return route(parts, router.value.visits)

    # The partition of an entry, cut into blocks of bounded size.
    placed = entries.mapInPandas(home, "v array<double>, ids array<bigint>, parts array<int>")
    placed = placed.select("v", "ids", F.col("parts")[0].alias("part"))
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).drop("n")
    blocks = F.broadcast(sizes)  # a row for each partition
    placed = placed.join(blocks, "part").withColumn(
        "block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    )
    asked = usable(queries, key, vector)
    seekers = asked.select("v").distinct()
    routed = seekers.mapInPandas(visited, "v array<double>, parts array<int>")
    routed = routed.select("v", F.explode("parts").alias("part")).join(blocks, "part")
    routed = routed.select("v", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    limit = top + 1

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"v": [], "ids": [], "scores": []}
        if len(left) and len(right):
            x = np.array(right["v"].tolist(), dtype=np.float64)
            ids = right["ids"].to_numpy()
            first = np.array([i[0] for i in ids])
            largest = np.abs(x).max()
            for at in range(0, len(left), QUERY_CHUNK):
                asked_rows = left["v"].iloc[at : at + QUERY_CHUNK]
                q = np.array(asked_rows.tolist(), dtype=np.float64)
                rough = q @ x.T
                # all that may tie with the last one asked for, as the last digits of a product may differ
                many = min(limit, len(x))
                least = np.partition(rough, len(x) - many, axis=1)[:, len(x) - many]
                margin = 4 * (q.shape[1] + 1) * np.finfo(np.float64).eps * np.abs(q).sum(axis=1) * largest
                for vec, row, line, cut in zip(asked_rows, q, rough, least - margin):
                    own = np.flatnonzero(line >= cut)
                    scores = (x[own] * row).sum(axis=1)
                    order = np.lexsort((first[own], -scores))[:limit]
                    found, values = [], []
                    for i in order:
                        found.extend(ids[own[i]])
                        values.extend([scores[i]] * len(ids[own[i]]))
                    out["v"].append(vec)
                    out["ids"].append(np.array(found, dtype=np.int64))
                    out["scores"].append(np.array(values))
        return pd.DataFrame(out)

    found = (
        routed.groupBy("part", "block")
        .cogroup(placed.groupBy("part", "block"))
        .applyInPandas(rerank, "v array<double>, ids array<bigint>, scores array<double>")
    )
    # at most visits x blocks short lists meet for a query
    pair = F.arrays_zip(F.col("scores"), F.col("ids"))
    merged = found.groupBy("v").agg(F.flatten(F.collect_list(pair)).alias("pairs"))
    ordered = F.slice(
        F.array_sort(
            F.transform("pairs", lambda p: F.struct((-p["scores"]).alias("down"), p["ids"].alias("id")))
        ),
        1,
        limit,
    )
    merged = merged.select("v", ordered.alias("best"))
    answers = asked.distinct().join(merged, "v").select(
        F.col("id").alias("query_id"),
        F.slice(F.filter("best", lambda p: p["id"] != F.col("id")), 1, top).alias("best"),
    )
    rows = answers.select("query_id", F.posexplode("best").alias("place", "hit"))
    return rows.select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias(key),
        (-F.col("hit.down")).alias("score"),
    )

"""Mine hard negatives from candidate blocks in the order of a Hilbert curve.

Candidates are sorted by label and then along a Hilbert curve through their components,
so that a block of ``BLOCK_ROWS`` consecutive rows has one label and covers a small box.
Blocks are stored as Parquet in that order; each has a zone map, the smallest and largest
value of every component. For an anchor, interval arithmetic on a zone map gives bounds
of the scores in a block (sums of the smaller and larger products with either end).

Both searches, for an anchor's best rows of its own label (the positives) and for the best
rows of other labels in each positive's window of scores, read blocks in two rounds: first
the ``SEEDS`` blocks of each group of zone maps with the highest bounds, which gives a
floor (the k-th best score so far), then every other block whose interval of scores
reaches the floor and the window. No block is left out that could hold an answer.

Anchors go in chunks of at most ``ANCHOR_CHUNK`` and zone maps in groups of at most
``ZONE_GROUP``, so a task holds one block or one group of zone maps, and one chunk. A label
of any size is many blocks. Nothing is collected but counts and the range of components.

Which rows take part is said in :func:`talkloom.llm.integers.integer_vectors`; rows
without a label do not. An anchor without other rows of its label, or whose windows hold
no row, has no result. Copies under several ids are rows of their own; ties go to smaller
ids. An empty table gives an empty result. Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.arrow import give_back, map_batches, map_partitions
from talkloom.llm.integers import integer_vectors, packed, pieces, product_type, unpacked

BLOCK_ROWS = 2_048
ANCHOR_CHUNK = 1_024
ZONE_GROUP = 1_024
SEEDS = 2
#: bits of each component that the curve sees
BITS = 4

_FOUND = "anchor_id bigint, window int, id bigint, score bigint"
_PAIR = "anchor_id bigint, chunk int, block bigint, upper bigint, lower bigint"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers below 2^bits, as rows of bytes.

    The published rotation method: from the highest bit down each axis either reflects the
    lower bits of the first axis or trades them with it; a Gray code of the axes follows.
    The bits of all axes, highest first, are the key.
    """
    axes = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in axes:
            high = (axis >> bit) & 1 == 1
            trade = np.where(high, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(high, low, trade)
            axis ^= trade
    gray = np.bitwise_xor.accumulate(axes, axis=0)
    flip = np.zeros_like(gray[-1])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((gray[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    gray ^= flip
    planes = np.stack([(gray >> bit) & 1 for bit in range(bits - 1, -1, -1)])
    return np.packbits(planes.reshape(-1, gray.shape[1]).T.astype(np.uint8), axis=1)


def _bounds(rows: DataFrame) -> tuple[int, int]:
    """The smallest and largest component of all rows."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        matrix = unpacked(batch.column(0))
        ends = [pa.array([int(matrix.min())]), pa.array([int(matrix.max())])]
        yield pa.RecordBatch.from_arrays(ends, ["low", "high"])

    ends = map_batches(rows.select("v"), run, "low bigint, high bigint")
    found = ends.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    return (found["low"], found["high"]) if found["low"] is not None else (0, 0)


def hilbert_blocks(rows: DataFrame, count: int) -> DataFrame:
    """The rows with their block; a block's last row is its zone map (id null; low, high).

    Blocks end with their label, their partition or after BLOCK_ROWS rows.
    """
    low, high = _bounds(rows)
    reach = high - low + 1

    def keys(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cells = ((unpacked(batch.column(2)).astype(np.int64) - low) << BITS) // reach
        curve = pa.array([row.tobytes() for row in hilbert_keys(cells, BITS)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, curve], ["id", "label", "v", "curve"])

    keyed = map_batches(
        rows.select("id", "label", "v"), keys, "id bigint, label bigint, v binary, curve binary"
    )
    order = ["label", "curve", "id"]
    # a few blocks a partition
    dealt = keyed.repartitionByRange(pieces(count, 8 * BLOCK_ROWS), *order)
    dealt = dealt.sortWithinPartitions(*order).select(
        F.spark_partition_id().cast("bigint").alias("part"), "id", "label", "v"
    )
    names = ["block", "id", "label", "v", "low", "high"]

    def block_of(number: int, held: pa.Table) -> pa.RecordBatch:
        matrix = unpacked(held.column("v"))
        n = len(matrix)
        label = held.column("label")[0].as_py()
        ends = [packed(m[None, :]).to_pylist()[0] for m in (matrix.min(axis=0), matrix.max(axis=0))]
        columns = [
            pa.array([number] * (n + 1), pa.int64()),
            pa.array([*held.column("id").to_pylist(), None], pa.int64()),
            pa.array([label] * (n + 1), pa.int64()),
            pa.array([*held.column("v").to_pylist(), None], pa.binary()),
            *(pa.array([None] * n + [end], pa.binary()) for end in ends),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        number = part = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows:
                labels = held.column("label").to_numpy()
                same = int(np.searchsorted(labels, labels[0], side="right"))
                if same == held.num_rows and same < BLOCK_ROWS:
                    break  # more of it may come
                n = min(same, BLOCK_ROWS)
                yield block_of((part << 32) | number, held.slice(0, n))
                number += 1
                held = held.slice(n)
        while held is not None and held.num_rows:
            yield block_of((part << 32) | number, held.slice(0, BLOCK_ROWS))
            number += 1
            held = held.slice(BLOCK_ROWS)

    schema = "block bigint, id bigint, label bigint, v binary, low binary, high binary"
    return map_partitions(dealt, cut, schema)


def _intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of each anchor (rows) in each zone (columns)."""
    kind = product_type(anchors, np.concatenate((low, high)))
    low, high = low.astype(kind).T, high.astype(kind).T
    up, down = np.maximum(anchors, 0).astype(kind), np.minimum(anchors, 0).astype(kind)
    return (up @ low + down @ high).astype(np.int64), (up @ high + down @ low).astype(np.int64)


def _windows(table: pa.Table) -> list[tuple[list[int], list[int]]]:
    """The smallest and largest score of each window of each anchor."""
    return list(zip(table.column("least").to_pylist(), table.column("most").to_pylist()))


def _chosen(zones: DataFrame, anchors: DataFrame, zone_groups: int, chunks: int, own: bool, seeds: bool) -> DataFrame:
    """anchor_id, chunk, block and bounds: the blocks in which an anchor's windows may lie.

    ``own``: blocks of the anchor's label, else those of other labels. ``seeds``: only the
    SEEDS highest of each group of zone maps.
    """

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(5)]
        if left.num_rows and right.num_rows:
            blocks, labels = left.column("block").to_numpy(), left.column("label").to_numpy()
            chunk = right.column("chunk")[0].as_py()
            lower, upper = _intervals(
                unpacked(right.column("v")), unpacked(left.column("low")), unpacked(left.column("high"))
            )
            own_labels = right.column("label").to_pylist()
            rows = zip(right.column("id").to_pylist(), own_labels, _windows(right), lower, upper)
            for anchor, label, (least, most), down, up in rows:
                fit = np.zeros(len(blocks), dtype=bool)
                for a, b in zip(least, most):
                    fit |= (up >= a) & (down <= b)
                at = np.flatnonzero(fit & ((labels == label) == own))
                if seeds and len(at) > SEEDS:
                    at = at[np.lexsort((blocks[at], -up[at]))[:SEEDS]]
                for i in at:
                    for column, value in zip(out, (anchor, chunk, blocks[i], up[i], down[i])):
                        column.append(int(value))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor_id", "chunk", "block", "upper", "lower"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    group = F.pmod(F.xxhash64("block"), F.lit(zone_groups)).cast("int").alias("zone_group")
    all_chunks = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    all_groups = F.explode(F.sequence(F.lit(0), F.lit(zone_groups - 1))).alias("zone_group")
    left = zones.select("block", "label", "low", "high", group).select("*", all_chunks)
    right = anchors.select("id", "label", "v", "chunk", "least", "most", all_groups)
    grouped = left.groupBy("zone_group", "chunk").cogroup(right.groupBy("zone_group", "chunk"))
    return grouped.applyInArrow(choose, _PAIR)


def _read(blocks: DataFrame, anchors: DataFrame, pairs: DataFrame, k: int, own: bool) -> DataFrame:
    """anchor_id, window, id and score: the ``k`` best rows of each window in each chosen block."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            left = left.sort_by("id")
            ids, matrix = left.column("id").to_numpy(), unpacked(left.column("v"))
            label = left.column("label")[0].as_py()
            vectors = unpacked(right.column("v"))
            kind = product_type(matrix, vectors)
            scores = (vectors.astype(kind) @ matrix.astype(kind).T).astype(np.int64)
            own_labels = right.column("label").to_pylist()
            rows = zip(right.column("id").to_pylist(), own_labels, _windows(right), scores)
            for anchor, own_label, (least, most), line in rows:
                if (own_label == label) != own:
                    continue
                fit = np.flatnonzero((line >= min(least)) & (line <= max(most)) & (ids != anchor))
                # rows are in the order of ids
                fit = fit[np.argsort(-line[fit], kind="stable")]
                down = -line[fit]
                for window, (a, b) in enumerate(zip(least, most)):
                    begin = np.searchsorted(down, -b, side="left")
                    end = np.searchsorted(down, -a, side="right")
                    at = fit[begin : min(end, begin + k)]
                    both = np.full(len(at), anchor), np.full(len(at), window)
                    for column, values in zip(out, (*both, ids[at], line[at])):
                        column.append(values.astype(np.int64))
        empty = np.zeros(0, dtype=np.int64)
        columns = [pa.array(np.concatenate([empty, *column])) for column in out]
        columns[1] = columns[1].cast(pa.int32())
        give_back()
        return pa.Table.from_arrays(columns, ["anchor_id", "window", "id", "score"])

    needed = pairs.select(F.col("block").alias("block"), F.col("chunk").alias("chunk")).distinct()
    left = blocks.where(F.col("id").isNotNull()).select("block", "id", "label", "v").join(needed, "block")
    asked = anchors.select(F.col("id").alias("anchor_id"), "label", "v", "least", "most")
    right = pairs.select("anchor_id", "chunk", "block").join(asked, "anchor_id")
    right = right.withColumnRenamed("anchor_id", "id")
    grouped = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
    return grouped.applyInArrow(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _in_two_rounds(
    stored: DataFrame, zones: DataFrame, anchors: DataFrame, sizes: tuple[int, int], k: int, own: bool, store
) -> DataFrame:
    """The ``k`` best rows of each anchor's windows (``least`` to ``most``), with their rank."""
    seeds = store(_chosen(zones, anchors, *sizes, own, True), "seed-blocks")
    first = store(_read(stored, anchors, seeds, k, own), "seed-results")
    # the k-th best so far is the least that a later row of its window must reach
    full = _best(first, k).where(F.col("rank") == k).select(
        F.col("anchor_id").alias("id"), F.struct(F.col("window"), F.col("score")).alias("floor")
    )
    floors = full.groupBy("id").agg(F.map_from_entries(F.collect_list("floor")).alias("floors"))
    raised = F.transform(
        "least",
        lambda a, i: F.greatest(a, F.coalesce(F.element_at(F.col("floors"), i.cast("int")), a)),
    )
    later = anchors.join(floors, "id", "left").withColumn("least", raised).drop("floors")
    others = _chosen(zones, later, *sizes, own, False)
    others = others.join(seeds.select("anchor_id", "block"), ["anchor_id", "block"], "left_anti")
    second = _read(stored, later, store(others, "other-blocks"), k, own)
    return _best(first.unionByName(second), k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    store: Callable[[DataFrame, str], DataFrame],
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition on the column ``id``. For each anchor and each of its best
    ``positives`` rows of the same label come the best ``negatives`` rows of other labels whose
    score is from ``least_percent`` to ``most_percent`` of the positive's.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = store(integer_vectors(vectors, key, vector, scale, label), "labelled-vectors")
    count = rows.count()
    stored = store(hilbert_blocks(rows, count), "hilbert-blocks")
    zones = stored.where(F.col("id").isNull()).select("block", "label", "low", "high")
    anchors = rows.where(is_anchor)
    chunks = pieces(anchors.count(), ANCHOR_CHUNK)
    sizes = (pieces(zones.count(), ZONE_GROUP), chunks)
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk")
    anchors = anchors.select("id", "label", "v", chunk)
    least = F.array(F.lit(-(1 << 62)).cast("bigint"))
    most = F.array(F.lit(1 << 62).cast("bigint"))
    everything = anchors.select("*", least.alias("least"), most.alias("most"))
    near = _in_two_rounds(stored, zones, everything, sizes, positives, True, store)
    near = store(near.select("anchor_id", F.col("id").alias("positive_id"), "rank", "score"), "positives")

    # a window of whole scores for each positive, in their order; none if its score is negative
    near = near.where("score >= 0")
    hundreds, rest = F.expr("score div 100"), F.col("score") % 100
    near = near.select(
        F.col("anchor_id").alias("id"),
        "rank",
        "positive_id",
        "score",
        (hundreds * least_percent + F.ceil(rest * least_percent / 100)).alias("low"),
        (hundreds * most_percent + F.floor(rest * most_percent / 100)).alias("high"),
    )
    near = near.where("low <= high").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "positive_id", "score", "low", "high"))).alias("near")
    )
    asked = anchors.join(near, "id").select(
        "*", F.col("near.low").alias("least"), F.col("near.high").alias("most")
    )
    found = _in_two_rounds(stored, zones, asked.drop("near"), sizes, negatives, False, store)
    positive = F.col("near")[F.col("window")]
    return found.join(near.withColumnRenamed("id", "anchor_id"), "anchor_id").select(
        "anchor_id",
        positive["positive_id"].alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )

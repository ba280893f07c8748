"""Rule statistics of whole texts, and an isolation forest on them.

Every tree of the forest splits a random subsample of the rows labelled good, as the
method has it, at random values of random features, and a text whose path to a leaf is
short is unlike the rest. The subsamples are drawn from all rows labelled good, the ranges
of the features and the threshold on the mean path come from every labelled row; which side
of a feature is good is never assumed.

Null or empty texts have all statistics 0 and fail the base rules. Repeated rows
get equal results. Without labelled rows of both kinds the forest accepts every
text, so only the base rules act. Texts of any length are read whole. An empty table
gives an empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.arrow import map_batches
from talkloom.llm.quantiles import quantile
from talkloom.llm.words import Slice, SpanHash, slices, words
from talkloom.sources.scratch import keep

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["words", "word_length", "symbols", "dup_lines", "repeats", "upper"]
WINDOW = 5
TREES = 128
SUBSAMPLE = 256
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANK_BYTES = [0x20, 0x09, 0x0B, 0x0C, 0x0D]


def _per_text(piece: Slice, marked: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marked, dtype=np.int64)))
    return total[piece.ends] - total[piece.starts]


def _repeated(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Order of (owner, key), and for each place whether an equal one comes before / after."""
    order = np.lexsort((keys, owner))
    same = (keys[order[1:]] == keys[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    before = np.concatenate(([False], same))
    after = np.concatenate((same, [False]))
    found_before, found_after = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    found_before[order], found_after[order] = before, after
    return found_before, found_after


def slice_statistics(piece: Slice) -> np.ndarray:
    """One row of STATISTICS and the line and upper-case counts for each text."""
    found = words(piece)
    n = len(piece)
    # characters: bytes that do not continue a UTF-8 sequence
    begins = (piece.data & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(begins, dtype=np.int64)))
    word_chars = np.bincount(found.text, chars[found.end] - chars[found.start], n)
    symbols = _per_text(piece, _SYMBOL[piece.data])
    upper = _per_text(piece, (piece.data >= 65) & (piece.data <= 90))

    # lines with a word; stable order makes the first of equal lines the earlier one
    breaks = np.flatnonzero(piece.data == 0x0A)
    begin, end = np.concatenate(([0], breaks[:-1] + 1)), breaks
    with_word = np.searchsorted(found.start, end) > np.searchsorted(found.start, begin)
    begin, end = begin[with_word], end[with_word]
    owner = np.searchsorted(piece.starts, begin, side="right") - 1
    hashes = SpanHash(piece.codes())(begin, end) if len(begin) else np.zeros(0, np.uint64)
    duplicate = _repeated(hashes, owner)[0] if len(begin) else np.zeros(0, bool)
    dup_lines = np.bincount(owner[duplicate], minlength=n)
    lines = np.bincount(owner, minlength=n)

    repeat = np.zeros(n, dtype=np.int64)
    count = len(found.start)
    if count >= WINDOW:
        grams = SpanHash(found.hash).grams(WINDOW)
        at = np.flatnonzero(found.text[WINDOW - 1 :] == found.text[: count - WINDOW + 1])
        before, after = _repeated(grams[at], found.text[at])
        cover = np.zeros(count + 1, dtype=np.int64)
        hit = at[before | after]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        covered = np.cumsum(cover[:-1]) > 0
        repeat = np.bincount(found.text[covered], minlength=n)
    columns = [found.counts, word_chars, symbols, dup_lines, repeat, lines, upper]
    return np.stack([np.asarray(c, dtype=np.int64) for c in columns], axis=1)


def batch_statistics(column: pa.Array) -> np.ndarray:
    parts = [slice_statistics(piece) for piece in slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, 7), np.int64)


def base_failed(statistics: np.ndarray) -> np.ndarray:
    """Fewer than 10 words, or over a fifth of them in repeated windows."""
    return (statistics[:, 0] < 10) | (100 * statistics[:, 4] > 20 * statistics[:, 0])


def features(statistics: np.ndarray) -> np.ndarray:
    """FEATURES of each text, sizeless."""
    n = np.maximum(statistics[:, 0], 1).astype(float)
    chars = np.maximum(statistics[:, 1], 1).astype(float)
    return np.stack(
        [
            np.log1p(statistics[:, 0]),
            np.log1p(statistics[:, 1] / n),
            np.sqrt(statistics[:, 2] / n),
            np.sqrt(statistics[:, 3] / np.maximum(statistics[:, 5], 1)),
            np.sqrt(statistics[:, 4] / n),
            np.sqrt(statistics[:, 6] / chars),
        ],
        axis=1,
    )


def _leaf_path(n: int) -> float:
    """Mean path of an unsuccessful search in a tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


@dataclass
class Forest:
    """Trees as arrays; a leaf has feature -1 and its path length as value."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    least_path: float

    def paths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, left, right in zip(self.feature, self.value, self.left, self.right):
            node = np.zeros(len(x), dtype=np.int64)
            live = feature[node] >= 0
            while live.any():
                at, own = node[live], rows[live]
                less = x[own, feature[at]] < value[at]
                node[live] = np.where(less, left[at], right[at])
                live = feature[node] >= 0
            total += value[node]
        return total / max(1, len(self.feature))

    def accepts(self, x: np.ndarray) -> np.ndarray:
        return self.paths(x) >= self.least_path


def _grow(x: np.ndarray, rng: np.random.Generator, most_depth: int, low, high):
    """A tree whose cuts are drawn from the box ``low`` to ``high``; a side may stay empty."""
    feature, value, left, right = [], [], [], []

    def node(rows: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray) -> int:
        here = len(feature)
        feature.append(-1)
        value.append(depth + _leaf_path(len(rows)))
        left.append(0)
        right.append(0)
        wide = np.flatnonzero(high > low)
        if depth < most_depth and len(rows) > 1 and len(wide):
            f = int(rng.choice(wide))
            cut = rng.uniform(low[f], high[f])
            less = rows[:, f] < cut
            below, above = high.copy(), low.copy()
            below[f] = above[f] = cut
            feature[here], value[here] = f, cut
            left[here] = node(rows[less], depth + 1, low, below)
            right[here] = node(rows[~less], depth + 1, above, high)
        return here

    node(x, 0, low, high)
    return feature, value, left, right


def grow_forest(
    base: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    trees: int = TREES,
    subsample: int = SUBSAMPLE,
    most_depth: int = 14,
    seed: int = 7,
) -> Forest:
    """Grow the forest on subsamples of ``base``; without a threshold it accepts every text.

    Cuts are drawn from the range ``low`` to ``high`` that all labelled rows span, so a
    region without good rows is cut off early.
    """
    rng = np.random.default_rng(seed)
    grown = []
    if len(base):
        for _ in range(trees):
            rows = rng.choice(len(base), min(subsample, len(base)), replace=False)
            grown.append(_grow(base[rows], rng, most_depth, low, high))
    width = max([len(t[0]) for t in grown], default=1)

    def packed(i: int, kind: type) -> np.ndarray:
        out = np.full((len(grown), width), -1 if i == 0 else 0, dtype=kind)
        for row, tree in zip(out, grown):
            row[: len(tree[i])] = tree[i]
        return out

    return Forest(packed(0, int), packed(1, float), packed(2, int), packed(3, int), -np.inf)


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, STATISTICS, n_lines and n_upper of every whole text."""
    kind = dict(docs.dtypes)[key]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = batch_statistics(batch.column(1))
        arrays = [batch.column(0), *(pa.array(table[:, i]) for i in range(table.shape[1]))]
        yield pa.RecordBatch.from_arrays(arrays, ["key", *STATISTICS, "n_lines", "n_upper"])

    names = ", ".join(f"{name} bigint" for name in [*STATISTICS, "n_lines", "n_upper"])
    return map_batches(docs.select(key, text), run, f"key {kind}, {names}").withColumnRenamed(
        "key", key
    )


def labelled_features(
    docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id"
) -> DataFrame:
    """Every labelled document once, stored: the key, good, ``base_failed`` and the features.

    Rows with a null key or label take no part; the smallest of several labels of one key
    counts, and the smallest statistics of several texts. Statistics are small, so they
    meet the labels instead of the texts.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg((F.min(label).cast("int") == 1).alias("good"))
    )
    names = [*STATISTICS, "n_lines", "n_upper"]
    found = text_statistics(docs.where(F.col(key).isNotNull()), key).join(known, key)
    once = found.groupBy(key, "good").agg(F.min(F.struct(*names)).alias("found"))
    kind = dict(docs.dtypes)[key]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 9)]
        table = np.stack(columns, axis=1)
        arrays = [batch.column(0), batch.column(1), pa.array(base_failed(table))]
        arrays += [pa.array(column) for column in features(table).T]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "good", "base_failed", *FEATURES])

    schema = f"key {kind}, good boolean, base_failed boolean, "
    schema += ", ".join(f"{name} double" for name in FEATURES)
    return keep(map_batches(once.select(key, "good", "found.*"), run, schema), "labelled-features")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The features of a batch, a row a document."""
    return np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in FEATURES], axis=1)


def fit_on_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    lost_good: float = 0.004,
) -> Forest:
    """Fit the forest on all labelled documents (1 is good).

    A forest can use ``TREES * SUBSAMPLE`` rows at most; so many good rows, chosen by a hash
    of the key, are dealt to the subsamples. Ranges and threshold are of every labelled row.
    Of the thresholds that reject at most ``lost_good`` of the good rows, the lowest that
    rejects the most bad rows is taken.
    """
    # the rest is decided without the forest
    passed = labelled_features(docs, labels, label, key).where("not base_failed")
    ends = [end(name) for end in (F.min, F.max) for name in FEATURES]
    n, n_good, *ends = passed.agg(F.count("*"), F.count_if("good"), *ends).first()
    if not n:
        return grow_forest(np.zeros((0, len(FEATURES))), None, None)
    low, high = np.array(ends).reshape(2, -1)
    base = passed.where("good") if n_good else passed
    base = base.orderBy(F.xxhash64("key"), "key").limit(TREES * SUBSAMPLE).toPandas()
    forest = grow_forest(base.sort_values("key", kind="stable")[FEATURES].to_numpy(), low, high)
    if 0 < n_good < n:
        shared = docs.sparkSession.sparkContext.broadcast(forest)

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            paths = pa.array(shared.value.paths(matrix(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("good"), paths], ["good", "path"])

        paths = keep(map_batches(passed, run, "good boolean, path double"), "labelled-paths")
        forest.least_path = least_kept(paths, "path", lost_good, n_good)
    return forest


def least_kept(rows: DataFrame, value: str, lost_good: float, n_good: int) -> float:
    """The lowest threshold that rejects the most bad rows and at most ``lost_good`` of the good."""
    limit = quantile(rows.where("good"), F.col(value), lost_good, n_good)
    bad = rows.where(~F.col("good") & (F.col(value) < limit)).agg(F.max(value)).first()[0]
    return -np.inf if bad is None else float(min(limit, np.nextafter(bad, np.inf)))


def quality_rules(docs: DataFrame, forest: Forest, key: str = "doc_id") -> DataFrame:
    """Statistics of every text, ``base_failed``, its ``path`` in the forest and ``kept``."""
    kind = dict(docs.dtypes)[key]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(forest)  # bounded by trees and subsample

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = batch_statistics(batch.column(1))
        failed = base_failed(table)
        paths = shared.value.paths(features(table))
        kept = ~failed & (paths >= shared.value.least_path)
        arrays = [batch.column(0), *(pa.array(table[:, i]) for i in range(5))]
        arrays += [pa.array(failed), pa.array(paths), pa.array(kept)]
        yield pa.RecordBatch.from_arrays(arrays, ["key", *STATISTICS, "base_failed", "path", "kept"])

    names = ", ".join(f"{name} bigint" for name in STATISTICS)
    schema = f"key {kind}, {names}, base_failed boolean, path double, kept boolean"
    return map_batches(docs.select(key, "text"), run, schema).withColumnRenamed("key", key)

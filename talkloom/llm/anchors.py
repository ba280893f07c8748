"""Find windows of consecutive symbols that occur more than once in a corpus.

A window's *anchor* is the run of ``k`` symbols in it with the smallest hash, the
leftmost of equals. Equal windows have equal anchors at the same place, so only
windows of one anchor need to meet. Consecutive windows share anchors: a text of n
symbols has about 2 n / (window - k + 2) anchors, and only these are shuffled. The
stretch of text that the windows of one anchor span is its *context*.

1. Count anchors and keep those found more than once. Nothing is lost, as a
   window that occurs twice has an anchor that does.
2. Contexts with equal contents form a class. All windows of a member that comes
   after the first one occur earlier.
3. For anchors with several classes, the first context of each class is read and
   handed to ``resolve``, which finds the windows that occur in an earlier class.

Counts and classes are aggregated map-side. The classes that hold more than one in
``HOT_CLASSES`` of all members are therefore fewer than ``HOT_CLASSES``; they are
broadcast, and their members meet them without a shuffle, so a passage found in a third
of all documents is no hot spot. The members of the other classes are shuffled. Anchors with more than ``MOST_CLASSES`` classes have every window
counted by itself in the same way, instead of in one task.

Contexts are compared by two 64-bit hashes (anchor and content).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.arrow import map_batches, map_partitions
from talkloom.llm.slots import among, bitmap
from talkloom.llm.words import Slice, SpanHash, mix, slices, version, words

MOST_CLASSES = 2_000
HOT_CLASSES = 1_024
_PLACE_BITS = np.uint64(28)
_PLACE = np.uint64((1 << 28) - 1)


@dataclass
class Symbols:
    """The symbols of a slice: hashes, and for each the text, the text's first symbol and its end."""

    span: SpanHash
    text: np.ndarray
    first: np.ndarray
    limit: np.ndarray
    begin: np.ndarray  # byte where each symbol begins and ends
    end: np.ndarray


def byte_symbols(piece: Slice) -> Symbols:
    lengths = piece.ends - piece.starts + 1
    text = np.repeat(np.arange(len(piece), dtype=np.int32), lengths)
    at = np.arange(len(piece.data))
    return Symbols(
        SpanHash(piece.codes()), text, piece.starts[text], piece.ends[text], at, at + 1
    )


def word_symbols(piece: Slice) -> Symbols:
    found = words(piece)
    first = found.first[found.text]
    limit = (found.first + found.counts)[found.text]
    return Symbols(SpanHash(found.hash), found.text, first, limit, found.start, found.end)


@dataclass(frozen=True)
class Scheme:
    """What a symbol is, and how long windows and anchors are (window below 256)."""

    symbols: Callable[[Slice], Symbols]
    window: int
    k: int
    same_document: bool  # whether an earlier place in the same document counts


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:])
        reach += step
    return out


def contexts(symbols: Symbols, window: int, k: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, lead of the anchor, anchor hash and content hash."""
    grams = symbols.span.grams(k)
    if len(grams) < window - k + 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    place = np.arange(len(grams), dtype=np.uint64)
    owner = _sliding_min((grams & ~_PLACE) | place, window - k + 1) & _PLACE
    at = np.flatnonzero(np.arange(len(owner)) + window <= symbols.limit[: len(owner)])
    own = owner[at].astype(np.int64)
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (own[1:] != own[:-1]) | (symbols.text[at[1:]] != symbols.text[at[:-1]])
    run = np.flatnonzero(fresh)
    first = at[run]
    last = at[np.concatenate((run[1:], [len(at)])) - 1] if len(run) else first
    count, lead = last - first + 1, own[run] - first
    shape = (count * 256 + lead).astype(np.uint64)
    content = mix(symbols.span(first, last + window) + shape * np.uint64(0x9E3779B97F4A7C15))
    return first, count, lead, grams[own[run]], content


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_rows(docs: DataFrame, scheme: Scheme, only_anchor: bool) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        versions = batch.column(1)
        for piece in slices(batch.column(2)):
            symbols = scheme.symbols(piece)
            first, count, lead, anchor, content = contexts(symbols, scheme.window, scheme.k)
            if only_anchor:
                yield pa.RecordBatch.from_arrays([_signed(anchor)], ["anchor"])
                continue
            row = symbols.text[first] + piece.first if len(first) else first
            place = ((first - symbols.first[first]) << 16) | (count << 8) | lead
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(anchor),
                    _signed(content),
                    pa.array(ids[row]),
                    versions.take(pa.array(row)),
                    pa.array(place),
                ],
                ["anchor", "content", "doc", "version", "place"],
            )

    if only_anchor:
        return map_batches(docs, run, "anchor bigint")
    schema = "anchor bigint, content bigint, doc bigint, version binary, place bigint"
    return map_batches(docs, run, schema)


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text", *kept: str) -> DataFrame:
    """doc, version and text: null ids come last, and rows of one id are told apart by text."""
    last = F.lit((1 << 63) - 1)
    return docs.select(
        F.coalesce(F.col(key).cast("bigint"), last).alias("doc"),
        version(text).alias("version"),
        F.col(text).alias("text"),
        *kept,
    )


def _class_contexts(docs: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """The text of the first context of each class."""
    bits = bitmap(classes, "doc")
    wanted = classes.groupBy("doc", "version").agg(
        F.collect_list(F.struct("anchor", "content", "place")).alias("list")
    )
    # repeated rows of one id and text are the same text: one of them is read
    texts = among(docs, "doc", bits).join(wanted, ["doc", "version"])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        docs_, versions, lists = (batch.column(i) for i in (0, 1, 3))
        for piece in slices(batch.column(2)):
            symbols = scheme.symbols(piece)
            # first symbol of each text: symbols come in order of texts
            begins = np.searchsorted(symbols.text, np.arange(len(piece)))
            out = {name: [] for name in ("anchor", "content", "doc", "place", "context")}
            for i in range(len(piece)):
                row = piece.first + i
                doc = docs_[row].as_py()
                for item in lists[row].as_py():
                    place = item["place"]
                    start = begins[i] + (place >> 16)
                    stop = start + ((place >> 8) & 255) + scheme.window - 2
                    out["anchor"].append(item["anchor"])
                    out["content"].append(item["content"])
                    out["doc"].append(doc)
                    out["place"].append(place)
                    out["context"].append(
                        piece.data[symbols.begin[start] : symbols.end[stop]].tobytes()
                    )
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out)
            )

    schema = "anchor bigint, content bigint, doc bigint, place bigint, context binary"
    return map_batches(texts.select("doc", "version", "text", "list"), run, schema).drop_duplicates(
        ["anchor", "content"]
    )


Group = tuple[np.ndarray, np.ndarray, list[bytes]]  # documents, places, contexts


def _resolved(
    rows: DataFrame, resolve: Callable[[list[Group]], list[list[list[int]]]], batch_bytes: int
) -> DataFrame:
    """Hand whole anchors to ``resolve``, several at a time; windows found go out as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the last anchor so far
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            anchors = table.column(0).to_numpy()
            cut = int(np.searchsorted(anchors, anchors[-1]))
            held = table.slice(cut).to_batches()
            if cut:
                yield from work(table.slice(0, cut))
        if held:
            yield from work(pa.Table.from_batches(held))

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        anchors = table.column("anchor").to_numpy()
        docs, places = table.column("doc").to_numpy(), table.column("place").to_numpy()
        texts = table.column("context").to_pylist()
        starts = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
        ends = np.concatenate((starts[1:], [len(anchors)]))
        at = 0
        while at < len(starts):
            groups, size, first = [], 0, at
            while at < len(starts) and (size < batch_bytes or not groups):
                a, b = starts[at], ends[at]
                groups.append((docs[a:b], places[a:b], texts[a:b]))
                size += sum(map(len, texts[a:b]))
                at += 1
            found = [windows for group in resolve(groups) for windows in group]
            rows = slice(starts[first], ends[at - 1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors[rows]),
                    pa.array(table.column("content").to_numpy()[rows]),
                    pa.array(found, pa.list_(pa.int32())),
                ],
                ["anchor", "content", "windows"],
            )

    sorted_rows = rows.repartition("anchor").sortWithinPartitions("anchor", "doc", "place")
    return map_partitions(sorted_rows, run, "anchor bigint, content bigint, windows array<int>")


def _window_rows(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """Every window of crowded anchors by itself: which occur in an earlier class."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        places = batch.column(3).to_numpy()
        for piece in slices(batch.column(4)):
            symbols = scheme.symbols(piece)
            begins = np.searchsorted(symbols.text, np.arange(len(piece) + 1))
            for i in range(len(piece)):
                row = piece.first + i
                count, lead = (int(places[row]) >> 8) & 255, int(places[row]) & 255
                at = begins[i] + np.arange(count)
                same = [batch.column(c)[row].as_py() for c in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([v] * count, pa.int64()) for v in same),
                        pa.array((int(places[row]) >> 16) + np.arange(count)),
                        pa.array(np.arange(count, dtype=np.int32)),
                        pa.array((np.arange(count) - lead).astype(np.int32)),
                        _signed(symbols.span(at, at + scheme.window)),
                    ],
                    ["anchor", "content", "doc", "start", "window", "offset", "hash"],
                )

    schema = "anchor bigint, content bigint, doc bigint, start bigint, window int, offset int, hash bigint"
    each = map_batches(rows.select("anchor", "content", "doc", "place", "context"), run, schema)
    order = F.struct("doc", "start") if scheme.same_document else F.struct("doc")
    key = ["anchor", "offset", "hash"]
    earliest = each.groupBy(*key).agg(F.min(order).alias("earliest"), F.count("*").alias("n"))
    late = each.join(earliest.where("n > 1"), key).where(order > F.col("earliest"))
    return late.groupBy("anchor", "content").agg(F.collect_list("window").alias("windows"))


def repeated_windows(
    docs: DataFrame,
    scheme: Scheme,
    resolve: Callable[[list[Group]], list[list[list[int]]]],
    store: Callable[[DataFrame, str], DataFrame],
    batch_bytes: int = 1 << 16,
) -> DataFrame:
    """Stretches of symbols covered by windows that also occur earlier.

    ``docs`` comes from :func:`keyed`. Returns doc, version and ``spans``, an array of
    (start, end) in symbols of the text, in no order and possibly overlapping.
    """
    counted = _anchor_rows(docs, scheme, True).groupBy("anchor").agg(F.count("*").alias("n"))
    # stored, so that both sides of the join are exchanges of its own, which Spark can split
    common = store(counted.where("n > 1").select("anchor"), "common-anchors")
    shared = _anchor_rows(docs, scheme, False).join(common, "anchor", "left_semi")
    shared = store(shared, "shared-anchors")
    classes = shared.groupBy("anchor", "content").agg(
        F.min(F.struct("doc", "place", "version")).alias("head"), F.count("*").alias("members")
    )
    classes = store(classes, "context-classes")
    several = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1")
    heads = classes.join(several, "anchor").select(
        "anchor", "content", "classes", "head.doc", "head.place", "head.version"
    )
    texts = _class_contexts(docs, heads.drop("classes"), scheme)
    texts = store(texts.join(several, "anchor"), "contexts")
    crowded = F.col("classes") > MOST_CLASSES
    found = _resolved(texts.where(~crowded).drop("classes"), resolve, batch_bytes)
    found = found.unionByName(_window_rows(texts.where(crowded), scheme))
    found = found.where(F.size("windows") > 0)

    order = ["doc", "place", "version"] if scheme.same_document else ["doc"]
    later = F.struct(*order) > F.struct(*[F.col(f"head.{c}").alias(c) for c in order])
    # what a class says of its members: its first place and at most ``window`` short numbers;
    # a class of one member without a window in an earlier class says nothing
    key = ["anchor", "content"]
    says = classes.join(found, key, "left").where((F.col("members") > 1) | F.col("windows").isNotNull())
    says = store(says, "class-answers")
    total = classes.agg(F.sum("members")).first()[0] or 0
    hot = F.col("members") > total / HOT_CLASSES
    few = F.broadcast(says.where(hot))  # below HOT_CLASSES rows
    met = shared.join(few, key).unionByName(
        shared.join(F.broadcast(says.where(hot).select(*key)), key, "left_anti").join(says.where(~hot), key)
    )
    members = met.withColumn("later", later).where(F.col("later") | F.col("windows").isNotNull())
    start = F.shiftright("place", 16)
    count = F.shiftright("place", 8).bitwiseAND(F.lit(255))
    window = F.lit(scheme.window)
    whole = F.array(F.struct(start.alias("start"), (start + count - 1 + window).alias("end")))
    single = F.transform(
        "windows", lambda w: F.struct((start + w).alias("start"), (start + w + window).alias("end"))
    )
    spans = members.select(
        "doc", "version", F.when(F.col("later"), whole).otherwise(single).alias("spans")
    )
    return spans.groupBy("doc", "version").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def with_spans(docs: DataFrame, spans: DataFrame, key: str, text: str) -> DataFrame:
    """Every row of ``docs``: ``row`` (all columns as a struct), text and spans (null if none).

    Texts that surely have no spans stay out of the shuffle.
    """
    bits = bitmap(spans, "doc")
    named = keyed(docs.select(key, text, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), key, text, "row")
    some = among(named, "doc", bits).join(spans, ["doc", "version"], "left")
    none = among(named, "doc", bits, wanted=False)
    none = none.withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    columns = ["row", "text", "spans"]
    return some.select(columns).unionByName(none.select(columns))


def merged_spans(column: pa.Array) -> Iterator[list[tuple[int, int]]]:
    """The spans of each row, sorted, disjoint and not touching; null counts as none."""
    offsets = column.offsets.to_numpy()
    fields = column.values
    starts, ends = (fields.field(i).to_numpy() for i in (0, 1))
    for a, b, some in zip(offsets[:-1], offsets[1:], column.is_valid().to_numpy(zero_copy_only=False)):
        if a == b or not some:
            yield []
            continue
        order = np.argsort(starts[a:b], kind="stable")
        start, end = starts[a:b][order], np.maximum.accumulate(ends[a:b][order])
        fresh = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
        last = np.concatenate((fresh[1:], [len(end)])) - 1
        yield list(zip(start[fresh].tolist(), end[last].tolist()))

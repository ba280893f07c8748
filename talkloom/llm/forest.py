"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct shingles of five words (A-Z lower-cased). Equal
sets are one class. A signature holds ``TREES`` x ``DEPTH`` minima; each tree is an
order of all classes by its own ``DEPTH`` minima, and classes that share at least
``LEAST`` leading minima are in one region. Where more than ``BESIDE`` classes share
all ``DEPTH`` minima, their order goes on through the minima of the other trees.
Candidates of a class in each tree are

* its neighbours in the sorted order, which have the longest common prefixes, and
* the pivot of every region it is in, at each depth from ``LEAST`` on: the member
  that lies in the largest regions over all trees. Where many copies differ from
  their original more than they may differ from each other, the pivot is the
  original.

Candidates whose signatures agree in too few places to be similar (more than four
standard deviations off) are left out; the others are confirmed on full sets.
Confirmation goes in two rounds: first the best partners of each class, then all
candidates that are not yet in one component. Components come from the links.

The forest can miss a link, above all between classes that share much text with very
many others. A third round therefore looks for every link between two components by an
exact prefix filter: with the shingles of each set in one common order, two similar
sets share one of their first shingles. The order puts those last that are frequent over
all sets, as counted in ``SLOTS`` counters that shingles share by their hash; the counts
decide how much work there is and not what is found. Pairs are left out by size and by
the places of the shared shingle alone, where no link is possible.

Orders are sorted by range, so a region of any size is spread over tasks; pairs
across the borders of partitions are made from their first and last rows.

Null or empty text has an empty set and is linked with nothing. Rows of one id are
told apart by their sets; equal rows get equal results. Null ids: a class takes its
smallest id that is not null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.arrow import map_batches, map_partitions
from talkloom.llm.components import components
from talkloom.llm.slots import among, bitmap
from talkloom.llm.words import Slice, SpanHash, lower_ascii, mix, slices, version, words
from talkloom.sources.scratch import with_small_batches

SHINGLE = 5
TREES = 24
DEPTH = 6
LEAST = 3
LEVELS = (3, 4, 6)
BESIDE = 8
PERCENT = 75
SIGNATURE = TREES * DEPTH
#: of SIGNATURE places, those that agree at the least: four standard deviations below 75 %
LEAST_AGREE = int(SIGNATURE * 0.75 - 4 * (SIGNATURE * 0.75 * 0.25) ** 0.5)
#: counters of shingles, whose sizes give the order of the prefix filter
SLOTS = 1 << 21
_SALTS = np.random.default_rng(424242).integers(1, 2**63, SIGNATURE, dtype=np.uint64) | np.uint64(1)


def shingle_sets(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a slice's texts, sorted in each, and how many each has."""
    lowered = Slice(piece.first, lower_ascii(piece.data), piece.starts, piece.ends)
    found = words(lowered)
    span = SpanHash(found.hash)
    n = len(found.start)
    grams = span.grams(SHINGLE)
    at = np.flatnonzero(found.text[SHINGLE - 1 :] == found.text[: max(0, n - SHINGLE + 1)])
    owner, values = found.text[at], grams[at]
    short = np.flatnonzero((found.counts > 0) & (found.counts < SHINGLE))
    if len(short):
        begin = found.first[short]
        count = found.counts[short].astype(np.uint64)
        whole = mix(span(begin, begin + found.counts[short]) + count)
        owner, values = np.concatenate((owner, short)), np.concatenate((values, whole))
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    owner, values = owner[fresh], values[fresh]
    return values, np.bincount(owner, minlength=len(piece))


def _signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima of each salted hash over each set, as 32 bits; big-endian, so bytes sort like numbers."""
    out = np.empty((len(starts), SIGNATURE), dtype=">u4")
    high = values >> np.uint64(32)
    for i, salt in enumerate(_SALTS):
        hashed = ((values * salt) ^ (high * (salt >> np.uint64(7)))) >> np.uint64(32)
        out[:, i] = np.minimum.reduceat(hashed, starts)
    return out


def _class_names(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each set."""
    one = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
    two = np.add.reduceat(mix(values + np.uint64(0x14057B7EF767814F)), starts)
    return np.stack((one, two), axis=1)


def document_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_shingles, cls (16 bytes, null if the set is empty) and signature of every document."""
    kind = dict(docs.dtypes)[key]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in slices(batch.column(1)):
            values, counts = shingle_sets(piece)
            some = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[some]
            classes: list[bytes | None] = [None] * len(piece)
            signatures: list[bytes | None] = [None] * len(piece)
            if len(some):
                names = _class_names(values, starts)
                minima = _signatures(values, starts)
                for i, name, row in zip(some, names, minima):
                    classes[i], signatures[i] = name.tobytes(), row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(piece.first, len(piece)),
                    pa.array(counts.astype(np.int64)),
                    pa.array(classes, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                ["key", "n_shingles", "cls", "signature"],
            )

    schema = f"key {kind}, n_shingles bigint, cls binary, signature binary"
    return map_batches(docs.select(key, text), run, schema).withColumnRenamed("key", key)


def _regions(classes: DataFrame, store) -> tuple[DataFrame, DataFrame]:
    """tree, order (its minima) and cls of all classes that share a region with another.

    Second, the same with ``deeper``: the minima of the other trees where an order is crowded.
    """
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))
    at = F.col("tree") * (4 * DEPTH)
    rows = classes.select("cls", "signature", F.explode(trees).alias("tree"))
    order = F.substring("signature", at + 1, F.lit(4 * DEPTH))
    rows = rows.select("cls", "tree", order.alias("order"))
    rows = rows.withColumn("region", F.substring("order", 1, 4 * LEAST))
    shared = rows.groupBy("tree", "region").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(shared.select("tree", "region"), ["tree", "region"], "left_semi")
    rows = store(rows.select("tree", "order", "cls"), "forest-regions")
    # minima that a whole region shares leave its order as it is, so they need no skipping
    crowded = rows.groupBy("tree", "order").agg(F.count("*").alias("n")).where(F.col("n") > BESIDE)
    rest = F.concat(
        F.substring("signature", at + (4 * DEPTH + 1), F.lit(4 * SIGNATURE)),
        F.substring("signature", F.lit(1), at),
    )
    deeper = rows.join(crowded, ["tree", "order"], "left_semi").join(classes, "cls")
    deeper = store(deeper.select("tree", "cls", rest.alias("deeper")), "crowded-orders")
    ordered = rows.join(deeper, ["tree", "cls"], "left")
    return rows, ordered.withColumn("deeper", F.coalesce("deeper", F.lit(b"")))


def _pivot_pairs(regions: DataFrame, store) -> DataFrame:
    """Each class with the pivot of each region it is in."""
    levels = F.array(*[F.lit(d) for d in LEVELS])
    deep = regions.select("cls", "tree", "order", F.explode(levels).alias("depth"))
    region = F.substring("order", F.lit(1), F.col("depth") * 4)
    deep = deep.select("cls", "tree", "depth", region.alias("region"))
    key = ["tree", "depth", "region"]
    sizes = deep.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    weight = (
        deep.join(sizes, key).groupBy("cls").agg(F.sum(F.log(F.col("n"))).alias("weight"))
    )
    weight = store(weight.select("cls", F.round("weight", 6).alias("weight")), "forest-weights")
    named = F.struct("weight", "cls")
    pivots = deep.join(weight, "cls").groupBy(*key).agg(F.max(named).alias("pivot"))
    joined = deep.join(pivots, key).where(F.col("cls") != F.col("pivot.cls"))
    return joined.select("cls", F.col("pivot.cls").alias("other"))


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many places short signatures agree, row by row."""
    return (x == y).sum(axis=1).astype(np.int32)


def _flat(column: pa.Array, width: int) -> np.ndarray:
    """A column of ``width`` bytes a row as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _neighbour_pairs(regions: DataFrame, signatures: DataFrame) -> DataFrame:
    """Each class with those up to BESIDE places before it in the order of its region.

    Pairs come as (a, b, agree), compared where they meet, so that those which cannot
    be similar are never shuffled. Rows with ``part`` are the first and last of their
    partition instead.
    """
    width = 4 * LEAST
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
    names = ["part", "place", "tree", "region", "a", "b", "agree"]

    def batch_of(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = last = None
        part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            rows = (
                batch.column(1).to_numpy(zero_copy_only=False),
                _flat(batch.column(2), 4 * DEPTH)[:, :width],
                _flat(batch.column(3), 16),
                _flat(batch.column(4), SIGNATURE),
            )
            fresh = 0 if last is None else len(last[0])
            if last is not None:
                rows = tuple(np.concatenate(x) for x in zip(last, rows))
            tree, region, cls, short = rows
            if head is None:
                head = tuple(x[:BESIDE] for x in rows)
            elif len(head[0]) < BESIDE:
                more = BESIDE - len(head[0])
                head = tuple(np.concatenate((x, y[fresh : fresh + more])) for x, y in zip(head, rows))
            for step in range(1, BESIDE + 1):
                at = np.arange(max(step, fresh), len(tree))
                at = at[(tree[at] == tree[at - step]) & (region[at] == region[at - step]).all(axis=1)]
                at = at[(cls[at] != cls[at - step]).any(axis=1)]
                agree = _agreeing(short[at], short[at - step])
                at, agree = at[agree >= LEAST_AGREE], agree[agree >= LEAST_AGREE]
                one = [row.tobytes() for row in cls[at]]
                two = [row.tobytes() for row in cls[at - step]]
                none = [None] * len(at)
                yield batch_of(
                    [none, none, none, none, list(map(min, one, two)), list(map(max, one, two)), agree]
                )
            last = tuple(x[-BESIDE:] for x in rows)
        if part is not None:
            # a short partition's rows are both its first and its last
            n, m = len(head[0]), len(last[0])
            place = [*range(n), *range(-m, 0)]
            ends = [np.concatenate(x) for x in zip(head, last)]
            none = [None] * (n + m)
            named = [[row.tobytes() for row in x] for x in ends[1:3]]
            yield batch_of([[part] * (n + m), place, ends[0], *named, none, none])

    order = ["tree", "order", "deeper", "cls"]
    ordered = regions.join(signatures, "cls").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = ordered.select(F.spark_partition_id().alias("part"), "tree", "order", "cls", "short")
    schema = "part int, place int, tree int, region binary, a binary, b binary, agree int"
    return map_partitions(rows, run, schema)


def _border_pairs(found: DataFrame) -> DataFrame:
    """Pairs of the last rows of one partition with the first rows of the next."""
    ends = found.where(F.col("part").isNotNull())
    after = ends.where("place >= 0").select(
        (F.col("part") - 1).alias("part"), "tree", "region", F.col("a").alias("other")
    )
    before = ends.where("place < 0").select("part", "tree", "region", F.col("a").alias("cls"))
    return before.join(after, ["part", "tree", "region"]).select("cls", "other")


def _likely(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) whose signatures agree often enough, with ``agree``."""
    pairs = pairs.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b"))
    pairs = pairs.where("a <> b").distinct()
    x = signatures.select(F.col("cls").alias("a"), F.col("short").alias("x"))
    y = signatures.select(F.col("cls").alias("b"), F.col("short").alias("y"))
    joined = pairs.join(x, "a").join(y, "b")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        agree = _agreeing(_flat(batch.column(2), SIGNATURE), _flat(batch.column(3), SIGNATURE))
        out = [batch.column(0), batch.column(1), pa.array(agree)]
        likely = pa.array(agree >= LEAST_AGREE)
        yield pa.RecordBatch.from_arrays(out, ["a", "b", "agree"]).filter(likely)

    return map_batches(joined.select("a", "b", "x", "y"), run, "a binary, b binary, agree int")


def _short_signatures(classes: DataFrame) -> DataFrame:
    """The lowest byte of each minimum: enough to compare, a quarter of the bytes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        full = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
        low = np.ascontiguousarray(full.reshape(-1, SIGNATURE, 4)[:, :, 3])
        short = pa.array([row.tobytes() for row in low], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), short], ["cls", "short"])

    return map_batches(classes.select("cls", "signature"), run, "cls binary, short binary")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar. ``texts`` has cls and text of each class."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for piece in slices(column):
            values, counts = shingle_sets(piece)
            out += np.split(values, np.cumsum(counts)[:-1])
        return out

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            keep = []
            for x, y in zip(sets(part.column(2)), sets(part.column(3))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            rows = pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"])
            yield rows.filter(pa.array(keep, pa.bool_()))

    x = texts.select(F.col("cls").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("cls").alias("b"), F.col("text").alias("y"))
    joined = pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return map_batches(joined, run, "a binary, b binary")


def _head(key: str) -> Column:
    """The id of a row, the largest number for null."""
    return F.coalesce(F.col(key).cast("bigint"), F.lit((1 << 63) - 1))


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame, key: str, text: str) -> DataFrame:
    """cls and text of the classes in ``pairs``; other texts stay out of the shuffle."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    heads = classes.join(wanted, "cls", "left_semi").select("cls", "head", "version")
    bits = bitmap(heads, "head")
    rows = docs.select(
        _head(key).alias("head"),
        version(text).alias("version"),
        F.col(text).alias("text"),
    )
    found = among(rows, "head", bits).join(heads, ["head", "version"])
    return found.groupBy("cls").agg(F.first("text").alias("text"))


def _slot_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of all ``sets`` (text) fall into each of SLOTS slots.

    A task sends the counts that are not zero, in pieces, and pieces are summed as they
    come, so tasks and driver hold no more than the slots.
    """
    each = 1 << 15

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(SLOTS, dtype=np.uint32)
        for batch in batches:
            for piece in slices(batch.column(0)):
                values, _ = shingle_sets(piece)
                slots, counts = np.unique(values % np.uint64(SLOTS), return_counts=True)
                found[slots.astype(np.int64)] += counts.astype(np.uint32)
        yield from sent(found)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
                own = found.setdefault(part, np.zeros(each, dtype=np.uint32))
                own[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint32)
        for part, own in found.items():
            yield row_of(part, own)

    def row_of(part: int, counts: np.ndarray) -> pa.RecordBatch:
        places = np.flatnonzero(counts)
        columns = [
            pa.array([part], pa.int32()),
            pa.array([places.astype(np.uint16).tobytes()], pa.binary()),
            pa.array([counts[places].tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "places", "counts"])

    def sent(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for part, own in enumerate(found.reshape(-1, each)):
            if own.any():
                yield row_of(part, own)

    schema = "part int, places binary, counts binary"
    counted = map_partitions(sets.select("text"), count, schema).repartition("part")
    with with_small_batches(sets.sparkSession):
        table = map_partitions(counted, add, schema).toArrow()
    out = np.zeros((SLOTS // each, each), dtype=np.uint32)
    for part, places, counts in zip(*(column.to_pylist() for column in table.columns)):
        out[part, np.frombuffer(places, np.uint16)] = np.frombuffer(counts, np.uint32)
    return out.reshape(-1)


def _prefixes(sets: DataFrame, counts: np.ndarray) -> DataFrame:
    """cls, n and the first shingles of each set, of which similar sets share one."""
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for piece in slices(batch.column(0)):
            values, counts = shingle_sets(piece)
            some = np.flatnonzero(counts)
            if not len(some):
                continue
            counts = counts[some]
            starts = np.cumsum(counts) - counts
            names = _class_names(values, starts)
            owner = np.repeat(np.arange(len(some)), counts)
            rank = often[(values % np.uint64(SLOTS)).astype(np.int64)]
            # values come sorted, and stay so among equal ranks
            values = values[np.lexsort((rank, owner))]
            length = counts - (PERCENT * counts + 99) // 100 + 1
            first = values[np.arange(len(values)) - starts[owner] < length[owner]]
            offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(first.view(np.int64)))
            classes = pa.array([name.tobytes() for name in names], pa.binary())
            arrays = [classes, pa.array(counts.astype(np.int32)), lists]
            yield pa.RecordBatch.from_arrays(arrays, ["cls", "n", "prefix"])

    return map_batches(sets.select("text"), run, "cls binary, n int, prefix array<bigint>")


def _possible_pairs(docs: DataFrame, placed: DataFrame, store, key: str, text: str) -> DataFrame:
    """All pairs (a < b) of classes in different components that can be similar.

    ``placed`` has cls, head and component of each class. Shingles that only one class or
    one component has among its first are left out before pairs are made.
    """
    # copies of a set add nothing; those whose id is like a head's are dropped further down
    named = docs.select(_head(key).alias("head"), F.col(text).alias("text"))
    sets = among(named, "head", bitmap(placed, "head"))
    prefixes = store(_prefixes(sets, _slot_counts(sets)), "prefixes")
    # 64 bits stand for a class in the shuffle; should two be equal, both classes are taken
    rows = prefixes.select(
        F.xxhash64("cls").alias("mark"), "n", F.posexplode("prefix").alias("place", "shingle")
    )
    ends = rows.groupBy("shingle").agg(F.min("mark").alias("x"), F.max("mark").alias("y"))
    several = store(ends.where("x <> y").select("shingle"), "shared-shingles")
    rows = among(rows, "shingle", bitmap(several, "shingle")).join(several, "shingle", "left_semi")
    placed = placed.select("cls", "component", F.xxhash64("cls").alias("mark"))
    rows = rows.distinct().join(placed, "mark").drop("mark")
    mixed = rows.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    rows = rows.join(mixed.where("x <> y").select("shingle"), "shingle", "left_semi")
    rows = store(rows, "mixed-shingles")
    # a pair of n and m shingles is similar if it shares PERCENT / (100 + PERCENT) of n + m, and what it can share
    # from its first shared shingle on is bounded by what follows there
    tail = F.col("n") - F.col("place")
    short = rows.where((100 + PERCENT) * tail >= 2 * PERCENT * F.col("n")).alias("s")
    long = rows.alias("l")
    left = F.least(F.col("s.n") - F.col("s.place"), F.col("l.n") - F.col("l.place"))
    pairs = short.join(
        long,
        (F.col("s.shingle") == F.col("l.shingle"))
        & (F.col("s.component") != F.col("l.component"))
        & (F.col("s.n") <= F.col("l.n"))
        & ((F.col("s.n") < F.col("l.n")) | (F.col("s.cls") < F.col("l.cls")))
        & (100 * F.col("s.n") >= PERCENT * F.col("l.n"))
        & ((100 + PERCENT) * left >= PERCENT * (F.col("s.n") + F.col("l.n"))),
    )
    a, b = F.least("s.cls", "l.cls").alias("a"), F.greatest("s.cls", "l.cls").alias("b")
    return pairs.select(a, b).distinct()


def near_duplicates(
    docs: DataFrame,
    store: Callable[[DataFrame, str], DataFrame],
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Key, n_shingles, component_id (smallest id linked, its own included) and kept.

    ``kept`` holds where the id is the component's. Ids may be null or shared, so ``first``
    names one text of each component besides: the one of the smallest id, then ``version``.
    Texts without words are first of their own.
    """
    numbered = docs.select(F.col(key).cast("bigint").alias("doc"), version(text).alias("version"), text)
    numbered = numbered.select(F.struct("doc", "version").alias("doc"), text)
    shingled = store(document_classes(numbered, "doc", text), "shingled")
    last = F.lit((1 << 63) - 1)
    head = F.struct(F.coalesce("doc.doc", last).alias("doc"), F.col("doc.version").alias("version"))
    classes = (
        shingled.where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(F.min(head).alias("head"), F.first("signature").alias("signature"))
        .select("cls", F.col("head.doc").alias("head"), "head.version", "signature")
    )
    classes = store(classes, "shingle-classes")
    regions, ordered = _regions(classes, store)
    signatures = _short_signatures(classes)
    beside = store(_neighbour_pairs(ordered, signatures), "forest-neighbours")
    pairs = _border_pairs(beside).unionByName(_pivot_pairs(regions, store))
    near = beside.where(F.col("part").isNull()).select("a", "b", "agree")
    likely = store(near.unionByName(_likely(pairs, signatures)).distinct(), "likely-pairs")
    texts = store(_texts(docs, classes, likely, key, text), "pair-texts")

    # round 1: the best partner of each class
    both = likely.unionByName(likely.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
    best = both.groupBy("a").agg(F.max(F.struct("agree", "b")).alias("best"))
    chosen = best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b"))
    links = store(_confirmed(chosen.distinct(), texts), "first-links")
    group = components(links, store)
    # round 2: all pairs that are not in one component yet
    left = group.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = group.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    apart = likely.join(left, "a", "left").join(right, "b", "left")
    apart = apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    apart = apart.join(chosen.distinct(), ["a", "b"], "left_anti")
    more = store(_confirmed(apart, texts), "second-links")
    links = links.unionByName(more)
    group = components(links, store)
    # round 3: every link between components that the forest has not found
    placed = classes.join(group.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "head", F.coalesce("component", "cls").alias("component")
    )
    possible = store(_possible_pairs(docs, placed, store, key, text), "possible-pairs")
    texts = _texts(docs, classes, possible, key, text)
    missed = store(_confirmed(possible, texts), "third-links")
    if missed.head(1):
        group = components(links.unionByName(missed), store)

    placed = classes.join(group.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", F.struct("head", "version").alias("head"), F.coalesce("component", "cls").alias("component")
    )
    least = placed.groupBy("component").agg(F.min("head").alias("least"))
    named = placed.join(least, "component").select("cls", "least")
    rows = shingled.select("doc", "n_shingles", "cls").join(named, "cls", "left")
    component = F.when(F.col("least.head") < last, F.col("least.head"))
    first = (F.coalesce("doc.doc", last) == F.col("least.head")) & (
        F.col("doc.version") == F.col("least.version")
    )
    rows = rows.select(
        F.col("doc.doc").alias(key),
        F.col("doc.version").alias("version"),
        "n_shingles",
        F.when(F.col("cls").isNull(), F.col("doc.doc")).otherwise(component).alias("component_id"),
        F.coalesce(first, F.lit(True)).alias("first"),
    )
    return rows.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def deduplicated(
    docs: DataFrame,
    store: Callable[[DataFrame, str], DataFrame],
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with one document of each component, all columns kept; of equal rows one stays.

    Rows that surely stay are not shuffled.
    """
    found = store(near_duplicates(docs, store, key, text), "near-duplicates")
    by = [F.col(key).alias("_key"), F.col("version").alias("_version")]
    gone = found.where(~F.col("first")).select(*by).distinct()
    twice = found.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    doubt = store(gone.withColumn("_gone", F.lit(True)).unionByName(
        twice.withColumn("_gone", F.lit(False))
    ), "doubtful")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.select(F.col(key).alias("_key"), version(text).alias("_version"), row)
    last = F.lit(-1).cast("bigint")  # a null id has a slot of its own in the bitmap
    named = named.withColumn("_slot_key", F.coalesce(F.col("_key").cast("bigint"), last))
    noted = doubt.select(F.coalesce(F.col("_key").cast("bigint"), last).alias("_slot_key"))
    bits = bitmap(noted, "_slot_key")
    sure = among(named, "_slot_key", bits, wanted=False).select("row.*")
    rest = among(named, "_slot_key", bits).alias("n")
    out = doubt.where("_gone").alias("g")
    same = F.col("n._key").eqNullSafe(F.col("g._key")) & F.col("n._version").eqNullSafe(
        F.col("g._version")
    )
    rest = rest.join(out, same, "left_anti").groupBy("_key", "_version").agg(F.first("row").alias("row"))
    return sure.unionByName(rest.select("row.*"))

"""Find periodic runs of words in whole texts by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) of length max(LEAST_WORDS, LEAST_TIMES * q) or more, which no neighbouring
word extends keeping period q.

At each dyadic scale B the words are cut into blocks of B. A run whose period lies in
[B, 2B) holds a whole block and the block's next occurrence, B to 2B - 1 words later.
Sums of squared differences between a block and all places of the window that follows
it come from one exact convolution modulo primes (number theoretic transform); their
product is larger than any such sum, so a sum is zero modulo all of them only if no word
differs. Each distance found seeds an extension to both sides by comparing words.

Two exact rules leave blocks out before they are transformed: a block repeats at a
distance below 2B only if every word in it does, and a block whose window lies in a run
found at a smaller scale can only give multiples of that run's period.

Words are numbered within their text, so equal numbers are equal words and no hashes
stand for them. Texts are joined into slices of bounded size; a single text is never
cut, however long it is. A task holds one slice at a time.

Null and empty texts have no words and no runs. Rows are independent: repeated rows and
ids, null ids and further columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.arrow import map_batches

LEAST_WORDS = 6
LEAST_TIMES = 4
SLICE_BYTES = 1 << 19
#: numbers transformed at once
BATCH = 1 << 18
#: primes of the form k * 2^m + 1 below 2^31, with a generator: transforms up to 2^25 numbers
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))

#: the original word at each place of a text of n words, or None where it stays as it is
Order = Callable[[int | None, int], np.ndarray | None]


class Transform:
    """Number theoretic transforms of one size modulo one prime, row by row."""

    def __init__(self, size: int, prime: int, generator: int) -> None:
        self.size, self.prime = size, np.uint64(prime)
        root = pow(generator, (prime - 1) // size, prime)
        self.inverse_size = np.uint64(pow(size, -1, prime))
        self.forward_roots = self._powers(root)
        self.backward_roots = self._powers(pow(root, -1, prime))

    def _powers(self, root: int) -> np.ndarray:
        """The first half of the powers of ``root``, by doubling."""
        half = max(1, self.size // 2)
        out = np.ones(half, dtype=np.uint64)
        done, step = 1, root
        while done < half:
            out[done : 2 * done] = out[:done] * np.uint64(step) % self.prime
            done, step = 2 * done, step * step % int(self.prime)
        return out

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Transforms of the rows, in bit-reversed order."""
        rows, half = len(x), self.size // 2
        while half:
            x = x.reshape(rows, -1, 2, half)
            low, high = x[:, :, 0], x[:, :, 1]
            roots = self.forward_roots[:: self.size // (2 * half)]
            total = (low + high) % self.prime
            apart = (low + (self.prime - high)) % self.prime * roots % self.prime
            x = np.stack((total, apart), axis=2)
            half //= 2
        return x.reshape(rows, self.size)

    def backward(self, x: np.ndarray) -> np.ndarray:
        """The rows whose transforms, in bit-reversed order, are ``x``."""
        rows, half = len(x), 1
        while half < self.size:
            x = x.reshape(rows, -1, 2, half)
            low = x[:, :, 0]
            high = x[:, :, 1] * self.backward_roots[:: self.size // (2 * half)] % self.prime
            x = np.stack(((low + high) % self.prime, (low + (self.prime - high)) % self.prime), axis=2)
            half *= 2
        return x.reshape(rows, self.size) * self.inverse_size % self.prime


def equal_places(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Where the block of each row occurs in the row's window, as a matrix of booleans.

    ``blocks`` has B columns of numbers from 0, ``windows`` 2B - 1; place s is the window's
    columns s to s + B - 1.
    """
    width = blocks.shape[1]
    largest = int(max(blocks.max(initial=0), windows.max(initial=0)))
    primes, product = [], 1
    for prime in PRIMES:
        if product <= width * largest * largest:
            primes.append(prime)
            product *= prime[0]
    same = np.ones(blocks.shape, dtype=bool)
    for prime, generator in primes:
        transform = Transform(2 * width, prime, generator)
        modulus = np.uint64(prime)
        padded = np.zeros((len(blocks), 2 * width), dtype=np.uint64)
        padded[:, :width] = blocks[:, ::-1]
        one = transform.forward(padded)
        padded[:, :-1] = windows
        padded[:, -1] = 0
        both = one * transform.forward(padded) % modulus
        cross = transform.backward(both)[:, width - 1 : 2 * width - 1]
        squares = np.zeros((len(blocks), 2 * width), dtype=np.uint64)
        wide = windows.astype(np.uint64) % modulus
        np.cumsum(wide * wide % modulus, axis=1, out=squares[:, 1:])
        own = blocks.astype(np.uint64) % modulus
        own = (own * own % modulus).sum(axis=1, dtype=np.uint64)[:, None]
        there = squares[:, width:] - squares[:, :width]
        same &= (own + there) % modulus == (cross + cross) % modulus
    return same


def _next_gaps(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How far each word's next occurrence in its text is; a large number if there is none."""
    gaps = np.full(len(codes), np.iinfo(np.int64).max)
    order = np.argsort(text * (np.int64(codes.max(initial=0)) + 1) + codes, kind="stable")
    before, after = order[:-1], order[1:]
    same = (codes[before] == codes[after]) & (text[before] == text[after])
    gaps[before[same]] = after[same] - before[same]
    return gaps


def _matching(codes: np.ndarray, at: int, distance: int, stop: int, step: int) -> int:
    """The first place from ``at`` in direction ``step``, ``stop`` at the latest, whose word differs."""
    many = 32
    while at != stop:
        many = min(2 * many, 1 << 16, abs(stop - at))
        places = slice(at, at + many) if step > 0 else slice(at - many + 1, at + 1)
        there = slice(places.start + distance, places.stop + distance)
        differ = np.flatnonzero(codes[places] != codes[there])
        if len(differ):
            return places.start + int(differ[0] if step > 0 else differ[-1])
        at += step * many
    return stop


class _Covered:
    """Whether a stretch lies within one of the runs found so far."""

    def __init__(self, runs: list[tuple[int, int, int]]) -> None:
        runs = sorted(runs)
        self.starts = np.array([r[0] for r in runs], dtype=np.int64)
        ends = np.array([r[0] + r[1] for r in runs], dtype=np.int64)
        self.ends = np.concatenate(([-1], np.maximum.accumulate(ends) if len(ends) else ends))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.starts, start, side="right")] >= end


def _seeds(codes: np.ndarray, limit: np.ndarray, starts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of the blocks at ``starts`` and their occurrences in what follows."""
    found, away = [], []
    many = max(1, BATCH // (2 * scale))
    for at in range(0, len(starts), many):
        some = starts[at : at + many]
        blocks = codes[some[:, None] + np.arange(scale)]
        windows = codes[some[:, None] + scale + np.arange(2 * scale - 1)]
        row, shift = np.nonzero(equal_places(blocks, windows))
        inside = some[row] + 2 * scale + shift <= limit[some[row]]
        found.append(some[row[inside]])
        away.append(shift[inside] + scale)
    if not found:
        return starts[:0], starts[:0]
    return np.concatenate(found), np.concatenate(away)


def find_runs(codes: np.ndarray, lengths: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each of several texts, by start, then period.

    ``codes`` are the texts' words as numbers from 0, one text after the other, and
    ``lengths`` how many words each has.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    text = np.repeat(np.arange(len(lengths)), lengths)
    first, limit = begins[text], ends[text]
    n = len(codes)
    runs: list[tuple[int, int, int]] = []
    gaps = _next_gaps(codes, text) if n else codes
    longest = int(lengths.max(initial=0))
    scale = 1
    while LEAST_TIMES * scale <= longest:
        near = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(gaps < 2 * scale, out=near[1:])
        starts = np.arange(0, n - 2 * scale + 1, scale)
        starts = starts[near[starts + scale] - near[starts] == scale]
        starts = starts[starts + 2 * scale <= limit[starts]]
        covered = _Covered(runs)
        starts = starts[~covered(starts, np.minimum(starts + 3 * scale - 1, limit[starts]))]
        if len(starts):
            padded = np.concatenate((codes, np.zeros(3 * scale, dtype=codes.dtype)))
            start, distance = _seeds(padded, limit, starts, scale)
            fresh = ~covered(start, start + scale + distance)
            start, distance = start[fresh], distance[fresh]
            order = np.lexsort((start, distance))
            last, reached = 0, -1
            for s, d in zip(start[order].tolist(), distance[order].tolist()):
                if d == last and s < reached:
                    continue  # in the stretch just extended
                left = _matching(codes, s - 1, d, int(first[s]) - 1, -1) + 1
                right = _matching(codes, s + scale, d, int(limit[s]) - d, 1)
                last, reached = d, right
                length = right + d - left
                if length >= max(LEAST_WORDS, LEAST_TIMES * d):
                    runs.append((left, length, d))
        scale *= 2
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    for start, length, period in sorted(set(runs), key=lambda r: (r[0], r[2])):
        owner = int(text[start])
        out[owner].append((start - int(begins[owner]), length, period))
    return out


def _numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers from 0, equal words alike."""
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    stay = np.cumsum(gone)[:-1] == 0
    return [word for word, kept in zip(words, stay.tolist()) if kept]


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", order: Order | None = None
) -> DataFrame:
    """Key, n_words, runs (array of start, length, period) and collapsed text of every row.

    The collapsed text holds the words, joined by one space, that no run holds after its
    first period; it is binary, in the bytes of the text. ``order`` may name the original word at each
    place, given a row's key and number of words; the rest is then done on that sequence.
    """
    kind = dict(docs.dtypes)[key]
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def work(keys: list, texts: list[bytes | None]) -> pa.RecordBatch:
        held, codes = [], []
        for own, text_ in zip(keys, texts):
            words = (text_ or b"").split()  # at the six blanks, as the pattern of a word says
            places = order(own, len(words)) if order and words else None
            if places is not None:
                words = [words[i] for i in places.tolist()]
            held.append(words)
            codes.append(_numbered(words))
        lengths = np.array([len(words) for words in held], dtype=np.int64)
        found = find_runs(np.concatenate(codes), lengths)
        rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
        collapsed = [b" ".join(_kept(words, runs)) for words, runs in zip(held, found)]
        return pa.RecordBatch.from_arrays(
            [pa.array(lengths), pa.array(rows, run_type), pa.array(collapsed, pa.binary())],
            ["n_words", "runs", "collapsed"],
        )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = batch.column(1).cast(pa.large_binary())
        sizes = [n or 0 for n in pc.binary_length(sizes).to_pylist()]
        at = 0
        while at < batch.num_rows:
            end, size = at, 0
            while end < batch.num_rows and (end == at or size + sizes[end] <= SLICE_BYTES):
                size += sizes[end]
                end += 1
            part = batch.slice(at, end - at)
            done = work(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), *done.columns], ["key", *done.schema.names])
            at = end

    schema = (
        f"key {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>,"
        " collapsed binary"
    )
    return map_batches(docs.select(key, text), run, schema).withColumnRenamed("key", key)


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """The test tables' planted repeats: of ids whose checksum ends in 0 the tail repeats its start."""
    if doc_id is None:
        return None
    check = crc32(str(doc_id).encode())
    if check % 10:
        return None
    g = check // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, n_runs, the longest run (ties: smallest start, then period) and checksums of runs and kept words."""
    ranked = F.transform(
        "runs",
        lambda r: F.struct((-r["length"]).alias("down"), r["start"].alias("start"), r["period"].alias("period")),
    )
    best = F.array_min(ranked)  # null without runs
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    length = -best["down"]
    return found.select(
        key,
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.call_function("div", 1000 * length, best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

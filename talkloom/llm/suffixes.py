"""Remove repeated byte strings, found in suffix arrays built by linear grouping.

A 100-byte string that also starts earlier in the corpus (in a document with a
smaller id, or earlier in the same one) is removed: each byte that such a string
covers goes. :mod:`talkloom.llm.anchors` brings together the stretches that can
hold equal strings; where several different ones meet, a suffix array of them
puts equal strings next to each other.

The suffix array is built by grouping. Suffixes are grouped by their first symbol
and groups are taken in descending order. From each suffix of the group a pointer
goes to the nearest suffix before it that is in a smaller group; suffixes that are
pointed at have their prefix extended by the group's, so they move to a new group
above the rest of theirs, those pointed at more often above the others. In the
end suffixes with equal longest Lyndon prefix are together. One pass from the
smallest suffix on then follows the pointers back and puts each suffix at the
next place of its group. No names are given to prefixes and nothing recurses.

Null text counts as empty. Rows of one id are told apart by their text, and
come in order of a hash of it; rows that agree in both get the same result. Null
ids come last. An empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from talkloom.llm.arrow import map_partitions
from talkloom.llm.anchors import Group, Scheme, byte_symbols, keyed, merged_spans, repeated_windows, with_spans

WINDOW = 100
SCHEME = Scheme(byte_symbols, window=WINDOW, k=24, same_document=True)


def suffix_array(symbols: list[int]) -> list[int]:
    """Start positions of the suffixes in ascending order."""
    n = len(symbols)
    first: dict[int, list[int]] = {}
    for i, symbol in enumerate(symbols):
        first.setdefault(symbol, []).append(i)
    # a group is named by its first place in the result; `starts` finds it by its end
    members: dict[int, list[int]] = {}
    size, starts = [0] * (n + 1), [0] * (n + 1)
    group = [0] * n
    place = 0
    for symbol in sorted(first):
        found = first[symbol]
        members[place], size[place] = found, len(found)
        for i in found:
            group[i] = place
        starts[place + len(found)] = place
        place += len(found)

    smaller = [-1] * n
    end = n
    while end:
        own = starts[end]
        pointed: dict[int, int] = {}
        for i in members.pop(own):
            if group[i] != own:
                continue  # has moved to a higher group
            at = i - 1
            while at >= 0 and group[at] >= own:
                at = smaller[at]
            smaller[i] = at
            if at >= 0:
                pointed[at] = pointed.get(at, 0) + 1
        by_times: dict[int, list[int]] = {}
        for at, times in pointed.items():
            by_times.setdefault(times, []).append(at)
        for times in sorted(by_times, reverse=True):
            moving: dict[int, list[int]] = {}
            for at in by_times[times]:
                moving.setdefault(group[at], []).append(at)
            for old, found in moving.items():
                rest = size[old] - len(found)
                if not rest:
                    members[old] = found
                    continue
                new = old + rest
                size[old], size[new] = rest, len(found)
                starts[new], starts[new + len(found)] = old, new
                members[new] = found
                for at in found:
                    group[at] = new
        end = own

    result = [-1] * n
    following = list(range(n))
    done = bytearray(n)
    for rank in range(-1, n):
        at = n - 1 if rank < 0 else result[rank] - 1
        while at >= 0 and not done[at]:
            own = group[at]
            result[following[own]] = at
            following[own] += 1
            done[at] = 1
            at = smaller[at]
    return result


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (differ.bit_length() + 7) // 8


def _reach(strings: list[bytes]) -> list[int]:
    """For each string, the longest prefix it has in common with another."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    reach = [0] * len(strings)
    for i, j in zip(order, order[1:]):
        common = _common(strings[i], strings[j])
        reach[i] = max(reach[i], common)
        reach[j] = max(reach[j], common)
    return reach


def _stretches(group: Group, found: list[list[int]]) -> list[tuple[int, int, int]]:
    """The distinct parts of a group's contexts that can hold equal windows: context, start, end.

    No context agrees with another further to the left or right of the anchor than the
    longest common prefixes say, so windows beyond are unlike all others. Of equal
    parts the earliest stays; all windows of the others go to ``found``.
    """
    docs, places, texts = group
    leads = [int(place) & 255 for place in places]
    left = _reach([text[:lead][::-1] for text, lead in zip(texts, leads)])
    right = _reach([text[lead:] for text, lead in zip(texts, leads)])
    first: dict[tuple[bytes, int], tuple] = {}
    for c, (text, lead) in enumerate(zip(texts, leads)):
        start, end = lead - left[c], lead + right[c]
        if end - start < WINDOW:
            continue
        own = (int(docs[c]), (int(places[c]) >> 16) + start, c, start, end)
        key = (text[start:end], left[c])
        other = first.setdefault(key, own)
        if other is not own:
            if own < other:
                first[key], own = own, other
            _, _, late, start, end = own
            found[late].extend(range(start, end - WINDOW + 1))
    return [own[2:] for own in first.values()]


def repeats(groups: list[Group]) -> list[list[list[int]]]:
    """For each context of each group, its windows that also occur earlier."""
    data = bytearray()
    owner: list[tuple[int, int]] = []  # group and context of every place, or no window there
    window: list[int] = []
    order: list[tuple[int, int]] = []
    found: list[list[list[int]]] = [[[] for _ in texts] for _, _, texts in groups]
    for g, group in enumerate(groups):
        docs, places, texts = group
        parts = _stretches(group, found[g])
        if len(parts) < 2:
            continue  # nothing left to compare with
        for c, start, end in parts:
            count = end - start - WINDOW + 1
            begin = int(places[c]) >> 16
            doc = int(docs[c])
            owner += [(g, c)] * count + [(-1, -1)] * WINDOW
            window += list(range(start, start + count)) + [-1] * WINDOW
            order += [(doc, begin + w) for w in range(start, start + count)] + [(0, 0)] * WINDOW
            data += texts[c][start:end]
            data.append(0)

    def close(run: list[int]) -> None:
        earliest = min(order[at] for at in run)
        for at in run:
            if order[at] > earliest:
                g, c = owner[at]
                found[g][c].append(window[at])

    run: list[int] = []
    last = b""
    for at in suffix_array(list(data)):
        if window[at] < 0:
            continue
        text = bytes(data[at : at + WINDOW])
        if text != last:
            if len(run) > 1:
                close(run)
            run, last = [], text
        run.append(at)
    if len(run) > 1:
        close(run)
    return found


def repeated_bytes(
    docs: DataFrame, store: Callable, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row`` (all columns as a struct), text, and ``spans`` of bytes to remove."""
    spans = repeated_windows(keyed(docs, key, text), SCHEME, repeats, store)
    return with_spans(docs, store(spans, "byte-spans"), key, text)


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    out.append(text[at:])
    return b"".join(out)


def digests(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, n_bytes, n_removed, n_spans and kept_sha256 of :func:`repeated_bytes`."""
    kind = rows.schema["row"].dataType[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            texts = batch.column(1).cast(pa.binary())
            for value, spans in zip(texts, merged_spans(batch.column(2))):
                data = value.as_py() or b""
                kept = kept_bytes(data, spans)
                row = (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                for column, item in zip(out, row):
                    column.append(item)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(
                arrays, ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    schema = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    found = map_partitions(rows.select(f"row.{key}", "text", "spans"), run, schema)
    return found.withColumnRenamed("key", key)

"""Remove passages of words that another document holds, found by suffix automata.

A window of 13 consecutive words that also starts in a document with a smaller id
is removed: each word it covers goes. :mod:`talkloom.llm.anchors` makes the
reference shards, one for each anchor: the different stretches of text around it.
A shard's documents are taken in order of id. Each is streamed through the
automaton of the smaller ones, which gives for every word the longest suffix that
the reference holds (matching statistics); spans of 13 words or more are kept as
repeats; then the document is added to the automaton. So a text is only streamed
through automata of shards that can hold a match, instead of through all.

Null text has no words. Rows of one id are one document in parts: they are no
repeats of each other. Null ids come last. An empty table gives an empty result;
further columns are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from talkloom.llm.arrow import map_partitions
from talkloom.llm.anchors import Group, Scheme, keyed, merged_spans, repeated_windows, with_spans, word_symbols

WINDOW = 13
SCHEME = Scheme(word_symbols, window=WINDOW, k=4, same_document=False)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, symbol, target: int) -> int:
        """A copy of ``target`` for the strings that reach it through ``state`` or its links."""
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, symbol) -> int:
        target = self.next[last].get(symbol)
        if target is not None:
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, symbol, target)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and symbol not in self.next[last]:
            self.next[last][symbol] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][symbol]
            if self.length[target] != self.length[last] + 1:
                target = self._split(last, symbol, target)
            self.link[new] = target
        return new

    def add(self, sequence: list) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)

    def matches(self, sequence: list) -> list[int]:
        """For every place, the length of the longest match that ends there."""
        state, length, out = 0, 0, []
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                length += 1
            out.append(length)
        return out


def repeats(groups: list[Group]) -> list[list[list[int]]]:
    """For each context of each group, its windows that a smaller document holds."""
    found = []
    for docs, _, texts in groups:
        automaton = SuffixAutomaton()
        own: list[list[int]] = []
        waiting: list[list[bytes]] = []  # of the current document
        current = None
        for doc, text in zip(docs, texts):
            if doc != current:
                for sequence in waiting:
                    automaton.add(sequence)
                waiting, current = [], doc
            sequence = text.split()  # of bytes, so at the blanks of WORD alone
            ends = automaton.matches(sequence)
            own.append([i - WINDOW + 1 for i, n in enumerate(ends) if n >= WINDOW])
            waiting.append(sequence)
        found.append(own)
    return found


def repeated_words(
    docs: DataFrame, store: Callable, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row`` (all columns as a struct), text, and ``spans`` of words to remove."""
    spans = repeated_windows(keyed(docs, key, text), SCHEME, repeats, store)
    return with_spans(docs, store(spans, "word-spans"), key, text)


def digests(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, n_words, n_removed and kept_sha256 of :func:`repeated_words`."""
    kind = rows.schema["row"].dataType[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            texts = batch.column(1).cast(pa.binary())
            for value, spans in zip(texts, merged_spans(batch.column(2))):
                words = (value.as_py() or b"").split()
                kept, at = [], 0
                for start, end in spans:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                row = (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
                for column, item in zip(out, row):
                    column.append(item)
            kinds = [pa.int64(), pa.int64(), pa.string()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "n_words", "n_removed", "kept_sha256"])

    schema = f"key {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    found = map_partitions(rows.select(f"row.{key}", "text", "spans"), run, schema)
    return found.withColumnRenamed("key", key)


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without spans of words; a span goes with the blanks after it."""
    if not spans:
        return text
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start]])
        at = places[end]
    out.append(text[at:])
    return b"".join(out).rstrip()


def cleaned(rows: DataFrame) -> DataFrame:
    """``row`` and the text that is left, null where it was null."""
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            left = [
                without(t.as_py(), spans) if t.is_valid else None
                for t, spans in zip(texts, merged_spans(batch.column(2)))
            ]
            column = pa.array(left, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["row", "text"])

    return map_partitions(rows.select("row", "text", "spans"), run, f"row {kind}, text string")

"""Direct definitions of the operators' results, in plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeated_bytes(docs, window=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}; ids are distinct."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            piece = data[i : i + window]
            if piece in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeated_words(docs, window=13):
    """{doc_id: (n_words, n_removed, kept_sha256)}; ids are distinct."""
    seen, out = {}, {}
    for doc, text in sorted(docs):
        row = words(text)
        gone = [False] * len(row)
        for i in range(len(row) - window + 1):
            piece = tuple(row[i : i + window])
            if seen.setdefault(piece, doc) < doc:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(row, gone) if not g)
        out[doc] = (len(row), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, k=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    row = words(lowered)
    if not row:
        return frozenset()
    if len(row) < k:
        return frozenset([tuple(row)])
    return frozenset(tuple(row[i : i + k]) for i in range(len(row) - k + 1))


def near_duplicates(docs, percent=75):
    """{doc_id: (n_shingles, component_id)}; ids are distinct."""
    sets = {doc: shingles(text) for doc, text in docs}
    holders = defaultdict(list)
    for doc, found in sets.items():
        for s in found:
            holders[s].append(doc)
    shared = Counter()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                shared[min(a, b), max(a, b)] += 1
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


def rule_statistics(text):
    row = words(text)
    seen = Counter(tuple(row[i : i + 5]) for i in range(len(row) - 4))
    covered = set()
    for i in range(len(row) - 4):
        if seen[tuple(row[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines, earlier = 0, set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in earlier
            earlier.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(row), sum(map(len, row)), symbols, lines, len(covered))

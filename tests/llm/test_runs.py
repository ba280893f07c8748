"""Periodic runs against their definition."""

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from brute_force import words
from talkloom.llm import queries, runs


def _runs(row):
    """Every run (start, length, period) of a list of words, by start, then period."""
    found = []
    for q in range(1, len(row) // 4 + 1):
        i = 0
        while i + q < len(row):
            j = i
            while j + q < len(row) and row[j] == row[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(row[k] == row[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if j > i and length >= max(6, 4 * q) and not smaller:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _digest(doc, text):
    row = words(text)
    n, h = len(row), crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        row = [row[i] if i < a else row[a + (i - a) % p] for i in range(n)]
    found = _runs(row)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(row) if i not in gone)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    sums = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (len(found), *top, *sums)


def _codes(texts):
    return np.array([w for t in texts for w in t], dtype=np.int64), np.array([len(t) for t in texts])


def test_runs_of_random_sequences():
    random.seed(3)
    for _ in range(150):
        texts = []
        for _ in range(random.randint(1, 5)):
            letters = random.choice([1, 2, 3, 5])
            row = [random.randrange(letters) for _ in range(random.randint(0, 40))]
            part = [random.randrange(letters + 1) for _ in range(random.randint(1, 20))]
            row += part * random.randint(1, 9) + row[:7]
            texts.append(row if random.random() < 0.8 else row * 5)
        assert runs.find_runs(*_codes(texts)) == [_runs(t) for t in texts]


def test_transform_finds_equal_places_exactly():
    """Also where a sum of squares is a multiple of one prime, and with numbers that need several."""
    rng = np.random.default_rng(5)
    for width, largest in [(1, 3), (4, 2), (8, 10**6), (64, 3), (256, 2**24)]:
        blocks = rng.integers(0, largest, (20, width))
        windows = rng.integers(0, largest, (20, 2 * width - 1))
        for row in range(0, 20, 2):
            at = rng.integers(0, width)
            windows[row, at : at + width] = blocks[row]
        want = [
            [bool((windows[r, s : s + width] == blocks[r]).all()) for s in range(width)] for r in range(20)
        ]
        assert runs.equal_places(blocks, windows).tolist() == want
    prime = runs.PRIMES[0][0]
    both = runs.equal_places(np.array([[0, 0]]), np.array([[prime, 0, 0]]))
    assert both.tolist() == [[False, True]]


def test_long_runs():
    rng = np.random.default_rng(6)
    part = rng.integers(0, 10**6, 30_000)
    assert runs.find_runs(np.tile(part, 5), np.array([150_000])) == [[(0, 150_000, 30_000)]]
    assert runs.find_runs(np.zeros(200_000, dtype=np.int64), np.array([200_000])) == [[(0, 200_000, 1)]]


def test_query_equals_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for doc, text in docs:
        if len(text) < 4_000:
            assert got[doc] == _digest(doc, text), doc
    assert sum(r[0] > 0 for r in got.values()) >= 10


def test_edge_documents(spark, edge_docs, no_docs):
    short = edge_docs.where("doc_id is distinct from 10")
    got = runs.digests(runs.periodic_runs(short, order=runs.planted_order)).collect()
    want = [(d, *_digest(d, t)) for d, t in short.select("doc_id", "text").collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    found = runs.periodic_runs(edge_docs).where("doc_id = 10").first()
    assert [tuple(r) for r in found["runs"]] == [(0, 30_000, 1)] and bytes(found["collapsed"]) == b"x"
    assert runs.digests(runs.periodic_runs(no_docs)).count() == 0


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_threshold_search", "op13_hard_negatives"])
def test_twins(spark, name):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from oracle import compare, views

    folder = "/root/testdata/sf0.001"
    assert compare(spark, views(folder), folder, queries.queries()[name], queries.oracle_sql()[name]) > 0

"""The pipeline's stages, each against the direct definition on what its predecessor kept."""

import hashlib
from collections import Counter

import brute_force
import corpus_pipeline

from talkloom.sources.scratch import keep

SF = "/root/testdata/sf0.001"


def _texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(keep(stage(spark, kept[-1], SF), "stage"))
    raw, good, single, cleaned, mixed, tokens = kept
    assert all(df.columns == columns for df in kept[:-1])

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = raw.join(labels, "doc_id")
    left = good.join(labels, "doc_id")
    assert left.where("quality = 1").count() >= 0.97 * known.where("quality = 1").count()
    assert left.where("quality = 0").count() <= 0.2 * known.where("quality = 0").count()

    near = brute_force.near_duplicates(list(_texts(good).items()))
    assert set(_texts(single)) == {doc for doc, (_, component) in near.items() if doc == component}

    before, after = _texts(single), _texts(cleaned)
    want = brute_force.repeated_words(list(before.items()))
    for doc, (n_words, n_removed, digest) in want.items():
        words = brute_force.words(after[doc])
        assert len(words) == n_words - n_removed
        assert hashlib.sha256(" ".join(words).encode()).hexdigest() == digest
        assert n_removed or after[doc] == before[doc]
    assert cleaned.where("n_chars <> length(text)").count() == 0

    copies = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert set(copies) <= set(after) and max(copies.values()) <= 3

    rows = tokens.collect()
    assert Counter(r["doc_id"] for r in rows) == copies
    for r in rows:
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256((after[r["doc_id"]] or "").encode()).hexdigest()

"""From raw documents to token ids: each stage works on all its predecessor kept.

A stage is a function of (spark, docs, sf_dir). ``run`` writes each result as
Parquet in the folder that ``spark.checkpoint.dir`` names and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import forest, mixing, passages, quality, tokenize
from talkloom.sources.scratch import keep

RANKS = "byte_bpe_multi_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fitted = quality.fit_sites(docs, labels, lambda df: keep(df, "sites"))
    return quality.classify(docs, fitted).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return forest.deduplicated(docs, keep)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document holds; n_chars follows the text."""
    cleaned = passages.cleaned(passages.repeated_words(docs, keep))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return cleaned.select(
        *[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their targets."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded bytes, and the ids of every document."""
    ranks = public_tokenizers.path(RANKS)
    return tokenize.token_digests(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", drop_passages),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Two stages, the classifier and the tokenizer, have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

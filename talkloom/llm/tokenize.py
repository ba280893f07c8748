"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file is a parameter and is read by the tasks; it must lie at the same
path on every executor. The pre-splitting pattern never matches across a place
where a character that is no white space is followed by white space, so long
texts are cut there and the parts are encoded one by one, with the same ids.
Decoding joins the raw bytes of the tokens, so it never fails on a token that
holds part of a character.

Null and empty texts have no tokens. Rows are independent: repeated rows, ties
and extra columns need no rule. A text without a safe place is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from talkloom.llm.arrow import map_batches

LONG_TEXT = 1 << 16
_SAFE = re.compile(r"(?<=\S)(?=\s)")


def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file, without special tokens. Made once a task and then freed."""
    with open(rank_file, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """Cut a text before white space that follows another character, about every ``size``."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(tokenizer: tiktoken.Encoding, text: str, size: int = LONG_TEXT) -> list[int]:
    if len(text) <= size:
        return tokenizer.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_parts(text, size):
        ids += tokenizer.encode_ordinary(part)
    return ids


def encode_texts(
    docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key and ``ids`` (array of int) of every text."""

    def run(batch: pa.RecordBatch, tokenizer: tiktoken.Encoding) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            ids = [encode(tokenizer, x.as_py() or "") for x in part.column(1)]
            column = pa.array(ids, type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), column], ["key", "ids"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(key, text)
    found = map_batches(
        rows, run, f"key {kind}, ids array<int>", lambda: encoding(rank_file, pattern)
    )
    return found.withColumnRenamed("key", key)


def decode_ids(
    rows: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """Key and ``bytes`` (binary) of every list of ids; null counts as empty."""

    def run(batch: pa.RecordBatch, tokenizer: tiktoken.Encoding) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            raw = [tokenizer.decode_bytes(x.as_py() or []) for x in part.column(1)]
            column = pa.array(raw, type=pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), column], ["key", "bytes"])

    kind = dict(rows.dtypes)[key]
    found = map_batches(
        rows.select(key, ids), run, f"key {kind}, bytes binary", lambda: encoding(rank_file, pattern)
    )
    return found.withColumnRenamed("key", key)


def token_digests(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode and decode every text in one pass.

    Columns: the key, n_tokens long, ids_sha256 (decimal ids joined by commas),
    decoded_sha256 (the decoded bytes) and, if asked for, ids (array of int).
    """

    def start() -> tuple[tiktoken.Encoding, list[str]]:
        tokenizer = encoding(rank_file, pattern)
        return tokenizer, [str(i) for i in range(tokenizer.n_vocab)]

    def run(batch: pa.RecordBatch, made: tuple) -> Iterator[pa.RecordBatch]:
        tokenizer, names = made
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            counts, ids_digests, raw_digests, rows = [], [], [], []
            for value in part.column(1):
                ids = encode(tokenizer, value.as_py() or "")
                counts.append(len(ids))
                joined = ",".join([names[i] for i in ids])
                ids_digests.append(hashlib.sha256(joined.encode("ascii")).hexdigest())
                raw_digests.append(hashlib.sha256(tokenizer.decode_bytes(ids)).hexdigest())
                if with_ids:
                    rows.append(pa.array(ids, pa.int32()))
            arrays = [part.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(raw_digests)]
            labels = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(rows)))
                labels.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, labels)

    kind = dict(docs.dtypes)[key]
    schema = f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""
    found = map_batches(docs.select(key, text), run, schema, start)
    return found.withColumnRenamed("key", key)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session", autouse=True)
def package_in_workers(spark):
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])


@pytest.fixture(scope="session")
def store():
    from talkloom.sources.scratch import keep

    return keep


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    base = " ".join(f"w{i}" for i in range(60))
    other = base.replace("w30", "changed")
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, other, "de", "b"), (4, None, "en", None),
        (5, "", "en", "b"), (6, " \t\n", None, "b"), (7, "one two", "en", "c"),
        (8, "One TWO", "en", "c"), (9, "é" * 200, "fr", "c"), (10, "x " * 30_000, "en", "d"),
        (11, "prefix " + base + " suffix", "en", "d"), (12, "aaaa" * 200, "en", "a"),
        (12, "aaaa" * 200, "en", "a"), (14, "\x00nul\x0bbytes\x0c" * 20, "en", "a"),
        (15, "### $$$ bad!!\nline\nline\nline\n" * 9, "en", "a"), (None, base, "en", "a"),
        (None, None, None, None),
    ]
    names = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, names)
    extra = {c: docs["lang"] for c in ("row", "key", "size", "spans", "doc", "n", "cls", "copies")}
    return docs.withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")

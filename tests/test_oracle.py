"""Every query against its SQL twin on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, views  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF_DIR)


def test_every_query_has_a_twin():
    assert set(entry.core_queries()) == set(entry.core_oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.core_queries()))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, entry.core_queries()[name], entry.core_oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", sorted(n for n in entry.core_queries() if n.startswith("learning_stats")))
def test_statistics_on_the_larger_tables(spark, name):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, views(folder), folder, entry.core_queries()[name], entry.core_oracle_sql()[name]) > 0

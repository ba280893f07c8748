"""Intermediate tables go where the session says."""

import pytest

from talkloom.sources import scratch


class _Session:
    def __init__(self, master, named):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: named)})


def test_named_folder_wins():
    assert scratch.scratch_dir(_Session("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"


def test_cluster_needs_a_named_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(_Session("yarn", None))


def test_local_session_takes_the_folder_set_for_it(monkeypatch):
    monkeypatch.setattr(scratch, "_default", None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(_Session("local[2]", None))
    scratch.use_when_unset("/shared/scratch")
    assert scratch.scratch_dir(_Session("local[2]", None)) == "/shared/scratch"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(_Session("local-cluster[2,1,1024]", None))


def test_keep_gives_the_same_rows(spark):
    kept = scratch.keep(spark.range(5), "five")
    assert [r["id"] for r in kept.orderBy("id").collect()] == [0, 1, 2, 3, 4]
    assert kept.inputFiles()

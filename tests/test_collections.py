"""Stored collections: whole or unchanged after a write, and read no further than needed."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from talkloom.operators import catalog, lookup, search
from talkloom.plans import jobs
from talkloom.sources.files import read_collection, write_bucketed, write_collection


def _profiles(spark, n=40_000):
    return spark.range(n).select(
        F.format_string("%07d", "id").alias("video_id"),
        F.concat(F.lit("Talk "), F.col("id")).alias("title"),
        F.concat(F.lit("Speaker "), F.col("id") % 100).alias("speakers"),
        F.lit("u").alias("url"),
        F.lit("s").alias("slug"),
        F.array(F.concat(F.lit("t"), F.col("id") % 500), F.lit("all")).alias("tags"),
    )


def _scanned(df):
    """Rows that the file scan of a plan gave, before any filter."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_a_write_that_fails_halfway_leaves_the_collection(spark, tmp_path):
    base = str(tmp_path)
    good = spark.range(100)
    write_collection(good, base, "numbers")
    bad = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") == 990, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    with pytest.raises(PySparkException):
        write_collection(bad, base, "numbers")
    assert read_collection(spark, base, "numbers").count() == 100
    # a reader of the version before is not disturbed by the next write
    reader = read_collection(spark, base, "numbers")
    write_collection(spark.range(7), base, "numbers")
    assert reader.count() == 100 and read_collection(spark, base, "numbers").count() == 7
    write_collection(spark.range(3), base, "numbers", mode="append")
    assert read_collection(spark, base, "numbers").count() == 10
    for n in (1, 2):
        write_collection(spark.range(n), base, "numbers")
    assert read_collection(spark, base, "numbers").count() == 2
    assert len([d for d in tmp_path.joinpath("numbers").iterdir() if d.name.startswith("version-")]) == 2


def test_paths_stay_when_a_refresh_fails(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    write_collection(_profiles(spark, 300), base, "tedx_videos")
    before = jobs.refresh_paths(spark, base).first()
    assert before["videos_analyzed"] == 300 and before["total_paths"] > 0
    kept = read_collection(spark, base, "paths").count()

    def broken(profiles, unique):
        rows = profiles.select(F.col("video_id"), F.lit("topic").alias("type"), F.lit("t").alias("title"))
        return rows.where(F.when(F.col("video_id") > "0000200", F.raise_error(F.lit("x"))).isNull())

    with monkeypatch.context() as patch:
        patch.setattr(jobs.paths, "build_paths", broken)
        with pytest.raises(PySparkException):
            jobs.refresh_paths(spark, base)
    assert read_collection(spark, base, "paths").count() == kept
    write_collection(_profiles(spark, 0), base, "tedx_videos")
    with pytest.raises(ValueError):
        jobs.refresh_paths(spark, base)
    assert read_collection(spark, base, "paths").count() == kept


def test_a_lookup_reads_few_of_the_stored_rows(spark, tmp_path):
    n = 40_000
    write_collection(_profiles(spark, n).repartition(8), str(tmp_path), "videos", key="video_id")
    stored = read_collection(spark, str(tmp_path), "videos")
    one = lookup.get_talk(stored, "0012345")
    assert 0 < _scanned(one) <= n / 2 and one.count() == 1
    # an id within a file's range that is not there is told by the Bloom filter
    assert _scanned(lookup.get_talk(stored, "0012345x")) == 0
    assert [r["title"] for r in one.collect()] == ["Talk 12345"]


def test_records_of_one_user(spark, tmp_path):
    progress = spark.range(30_000).select(
        F.concat(F.lit("u"), F.col("id") % 1000).alias("userId"), F.col("id").cast("string").alias("talkId")
    ).repartition(8)
    jobs.load_records(progress, progress.limit(10), str(tmp_path))
    own = read_collection(spark, str(tmp_path), "tedx_user_progress").where("userId = 'u17'")
    assert 0 < _scanned(own) < 30_000 and own.count() == 30


def test_search_by_tag_reads_the_rows_of_the_tag(spark, tmp_path):
    profiles = _profiles(spark)
    write_collection(profiles.repartition(8), str(tmp_path), "videos", key="video_id")
    write_collection(search.tag_index(profiles), str(tmp_path), "tags", key="tag")
    stored, index = (read_collection(spark, str(tmp_path), n) for n in ("videos", "tags"))
    wanted = index.where(F.col("tag") == F.lower(F.lit("T17")))
    assert "EqualTo(tag,t17)" in wanted._jdf.queryExecution().executedPlan().toString()
    hits = search.search_by_tag(stored, "T17", index=index)
    assert "In(video_id, [" in hits._jdf.queryExecution().executedPlan().toString()
    plain = search.search_by_tag(stored, "T17")
    assert hits.collect() == plain.collect() and hits.count() == 5
    assert search.search_by_tag(stored, "none", index=index).count() == 0


def test_stored_lists_are_not_shuffled(spark, tmp_path):
    profiles = _profiles(spark, 2_000)
    entry = "array(named_struct('video_id', format_string('%07d', id + 1), 'score', 3D, 'reasons', array('x')))"
    lists = spark.range(2_000).selectExpr("format_string('%07d', id) as _id", f"{entry} as recommendations")
    videos = write_bucketed(profiles, f"{tmp_path}/v", "bucketed_videos", "video_id", 4)
    lists = write_bucketed(lists, f"{tmp_path}/l", "bucketed_lists", "_id", 4)
    requests = spark.range(100).selectExpr("format_string('%07d', id * 3) as talk_id")
    found = lookup.get_watch_next(requests, lists, videos)
    rows = sorted((r["talk_id"], r["video_id"]) for r in found.collect())
    assert rows == [(f"{3 * i:07d}", f"{3 * i + 1:07d}") for i in range(100)]
    # the only exchanges are those of the requests and of what their lists name
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[1]
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange") == 2
    assert "Exchange hashpartitioning(talk_id" in plan and "Exchange hashpartitioning(rec" in plan


def test_stored_lists_stay_in_fewer_buckets_than_the_session_shuffles_to(spark, tmp_path):
    profiles = _profiles(spark, 2_000)
    entry = "array(named_struct('video_id', format_string('%07d', id + 1), 'score', 3D, 'reasons', array('x')))"
    lists = spark.range(2_000).selectExpr("format_string('%07d', id) as _id", f"{entry} as recommendations")
    videos = write_bucketed(profiles, f"{tmp_path}/v", "few_videos", "video_id", 2)
    lists = write_bucketed(lists, f"{tmp_path}/l", "few_lists", "_id", 2)
    requests = spark.range(100).selectExpr("format_string('%07d', id * 3) as talk_id")
    found = lookup.get_watch_next(requests, lists, videos, buckets=2)
    assert {r["video_id"] for r in found.collect()} == {f"{3 * i + 1:07d}" for i in range(100)}
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[1]
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange") == 2
    titles = lookup.resolve_watch_next(requests, lists, videos.select("video_id", "title"), buckets=2)
    assert titles.selectExpr("inline(recommendations)").where("video.title is not null").count() == 100


def test_buckets_grow_with_the_talks(spark, tmp_path):
    entry = pytest.importorskip("__spark_entry__")
    for rows, buckets in ((10, entry.BUCKETS), (20 * entry.TALKS_A_BUCKET + 1, 21)):
        spark.range(rows).write.parquet(f"{tmp_path}/{rows}/orders.parquet")
        assert entry._buckets(spark, f"{tmp_path}/{rows}") == buckets


def test_search_talks(spark):
    talks = spark.createDataFrame(
        [("1", "Big cats", "A", "u", "About cats", "60", "2001-05-01"), ("2", "Dogs", "B", "u", "CATS too", "90", "2002"),
         ("2", "Dogs", "B", "u", "CATS too", "80", "2002"), ("3", "Birds", "C", "u", None, "x", None),
         (None, "cats", "D", "u", None, "60", None), ("10", "cat", "E", "u", "c", "120", "not a date")],
        "id string, title string, speakers string, url string, description string, duration string, publishedAt string",
    )
    progress = spark.createDataFrame(
        [("a", "2"), ("b", "2"), ("a", "2"), ("a", "1"), (None, "1"), ("c", "3"), ("a", None)],
        "userId string, talkId string",
    )

    def found(**asked):
        return [(r["id"], r["viewers"]) for r in search.search_talks(talks, progress, **asked).collect()]

    assert found() == [("2", 2), ("1", 1), ("3", 1), ("10", 0)]
    assert found(keyword="Cats") == [("2", 2), ("1", 1)]
    assert found(shortest=80) == [("2", 2), ("10", 0)] and found(shortest=81, longest=119.5) == [("2", 2)]
    assert found(longest=60) == [("1", 1)]
    assert found(first_year=2001, last_year=2001) == [("1", 1)] and found(first_year=2002) == [("2", 2)]
    assert found(limit=1) == [("2", 2)] and found(keyword="%") == []
    one = search.search_talks(talks, progress, keyword="dogs").first()
    assert one["duration_s"] == 80.0 and str(one["published_at"]) == "2002-01-01 00:00:00"
    assert catalog.clean_talks(talks.withColumn("slug", F.lit("s"))).count() == 4

"""Speaker and topic paths on the hand-made catalog and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from talkloom.functions import normalise, path_id, strip
from talkloom.operators import paths


@pytest.fixture(scope="module")
def profiles(spark):
    rows = [
        ("1", "Ann", None, ["AI", "ai", "ml", "x"]),
        ("2", "Ann", None, ["AI", "ai", "ml", "x"]),
        ("3", "Ann", None, ["AI", "ai", "ml", "x"]),
        ("4", "Bob", "\tAnn ", ["AI", "ai", "C++"]),
        ("5", "Bob, Ann", None, ["AI", "C++"]),
        ("6", None, None, ["C++", "C#"]),
        ("7", None, None, ["C#"]),
        ("8", None, None, ["C#"]),
    ]
    return spark.createDataFrame(
        rows, "video_id string, speakers string, presenterDisplayName string, tags array<string>"
    )


def test_speaker_paths(profiles):
    rows = paths.speaker_paths(profiles).collect()
    assert sorted((r["path_id"], r["video_id"], r["video_count"]) for r in rows) == [
        ("speaker_ann", v, 4) for v in "1234"
    ]


def test_topics_in_rank_order(profiles):
    ranked = paths.rank_paths(paths.topic_members(profiles), "topic").orderBy("rank").collect()
    assert [(r["title"], r["video_count"]) for r in ranked] == [
        ("AI", 5), ("ai", 4), ("C#", 3), ("C++", 3), ("ml", 3)
    ]


def test_near_duplicates(profiles):
    rows = paths.distinct_topic_paths(profiles)
    rows = rows.select("rank", "path_id", "title").distinct().orderBy("rank").collect()
    assert [(r["path_id"], r["title"]) for r in rows] == [
        ("topic_ai", "AI"), ("topic_c", "C#"), ("topic_c", "C++"), ("topic_ml", "ml")
    ]
    built = paths.build_paths(profiles)
    assert paths.path_summary(built, profiles).first().asDict() == {
        "speaker_paths": 1, "topic_paths": 4, "total_paths": 5, "videos_analyzed": 8
    }


def test_id_fallback_and_listed_speakers(spark):
    rows = [("1", "a", [" Ann", "Ann", None, ""]), ("", "b", ["Ann"]), ("", "", ["Ann"])]
    df = spark.createDataFrame(rows, "video_id string, _id string, speakers array<string>")
    got = {(r["title"], r["video_id"]) for r in paths.speaker_members(df).collect()}
    assert got == {("Ann", "1"), ("Ann", "b")}


def _greedy(sets, threshold, n):
    order = sorted(((t, v) for t, v in sets.items() if len(v) >= 3), key=lambda x: (-len(x[1]), x[0]))
    kept = []
    for title, talks in order[:n]:
        if all(len(talks & o) / len(talks | o) < threshold for _, o in kept):
            kept.append((title, talks))
    return [t for t, _ in kept]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_pass_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = [{str(rnd.randrange(40)) for _ in range(rnd.randrange(3, 15))} for _ in range(8)]
    sets = {}
    for i in range(40):
        talks = set(rnd.choice(base))
        for _ in range(rnd.randrange(3)):
            talks ^= {str(rnd.randrange(40))}
        sets[f"topic{i}"] = talks
    members = spark.createDataFrame(
        [(t, v) for t, vs in sets.items() for v in vs], "title string, video_id string"
    )
    ranked = paths.rank_paths(members, "topic")
    titles = members.groupBy("video_id").agg(F.collect_list("title").alias("titles"))
    kept = paths.drop_near_duplicates(ranked, titles, 0.6).orderBy("rank").collect()
    assert [r["title"] for r in kept] == _greedy(sets, 0.6, 30)


def test_texts(spark):
    text = "  École  Supérieure X \x1c"
    row = spark.range(1).select(
        normalise(F.lit(text)).alias("n"),
        path_id("topic", F.lit(text)).alias("p"),
        strip(F.lit(" \ta b\x1f ")).alias("s"),
        normalise(F.lit(None).cast("string")).alias("z"),
    ).first()
    assert tuple(row) == ("école supérieure x", "topic_cole_suprieure_x", "a b", "")


def test_kept_topics_overlap_less_than_the_threshold(profiles):
    members = {}
    for r in paths.distinct_topic_paths(profiles).collect():
        members.setdefault(r["title"], set()).add(r["video_id"])
    kept = list(members.values())
    assert all(
        len(a & b) / len(a | b) < paths.NEAR_DUPLICATE for i, a in enumerate(kept) for b in kept[:i]
    )


def test_near_duplicates_of_unique_profiles_need_no_shuffle_by_talk(profiles):
    sets = paths.topic_sets(profiles, unique=True)
    ranked = paths.rank_paths(paths.topic_members(profiles, unique=True), "topic")
    left = paths.drop_near_duplicates(ranked, sets)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "hashpartitioning(video_id" not in plan


def test_members_come_from_the_titles_that_are_ranked(spark):
    profiles = spark.createDataFrame(
        [(str(i), ["aa", f"own{i}"] + ["bb"] * (i % 2)) for i in range(8)],
        "video_id string, tags array<string>",
    )
    sets = paths.topic_sets(profiles, unique=True)
    ranked = paths.rank_paths(paths.topic_members(profiles, unique=True), "topic")
    held = {r["video_id"]: sorted(r["titles"]) for r in paths.ranked_titles(ranked, sets).collect()}
    assert held == {str(i): ["aa", "bb"] if i % 2 else ["aa"] for i in range(8)}
    found = paths.distinct_topic_paths(profiles, unique=True)
    assert found.count() == 12
    # no further pass over all tags
    assert "tags" not in found._jdf.queryExecution().executedPlan().toString()

"""Recommender against hand-derived lists and against brute force."""

import random
import re
from itertools import combinations

import pytest

from talkloom.operators import catalog, recommend


@pytest.fixture(scope="module")
def golden(spark):
    tags = spark.createDataFrame(
        [("1", "a"), ("1", "b"), ("2", "a"), ("2", "b"), ("3", "b"), ("3", "b"), ("4", None), ("9", "a")],
        "id string, tag string",
    )
    related = spark.createDataFrame(
        [("1", "3"), ("1", "3"), ("1", "1"), ("4", "8"), ("2", None)],
        "id string, related_id string",
    )
    return catalog.clean_tags(tags), catalog.clean_related(related)


def test_golden_lists(golden):
    rows = recommend.watch_next(*golden).collect()
    got = {
        r["_id"]: [(x["video_id"], x["score"], x["reasons"]) for x in r["recommendations"]]
        for r in rows
    }
    both, tag, link = ["related_video", "common_tags"], ["common_tags"], ["related_video"]
    assert got == {
        "1": [("3", 8.0, both), ("2", 6.0, tag), ("1", 5.0, link), ("9", 3.0, tag)],
        "2": [("1", 6.0, tag), ("3", 3.0, tag), ("9", 3.0, tag)],
        "3": [("1", 3.0, tag), ("2", 3.0, tag)],
        "4": [("8", 5.0, link)],
        "9": [("1", 3.0, tag), ("2", 3.0, tag)],
    }


def test_ties_by_text_order(spark):
    tags = spark.createDataFrame(
        [("5", "x"), ("9", "x"), ("10", "x")], "video_id string, tag string"
    )
    rows = recommend.common_tag_pairs(tags, 2).where("source_video_id = '5'").collect()
    assert sorted(r["candidate_video_id"] for r in rows) == ["10", "9"]
    scored = recommend.score(recommend.candidates(_no_links(spark), tags, 2))
    ranked = recommend.top_k(scored, 1).where("source_video_id = '5'").collect()
    assert [r["candidate_video_id"] for r in ranked] == ["10"]


def test_weights_are_checked(golden):
    tags, related = golden
    with pytest.raises(ValueError):
        recommend.score(recommend.candidates(related, tags), tag_weight=0)


def _no_links(spark):
    return spark.createDataFrame([], "source_video_id string, related_video_id string")


def _catalogue(seed):
    """Popular tags, copied tag sets, wide talks and a linking hub, all small."""
    rnd = random.Random(seed)
    ids = [str(i) for i in range(60)]
    sets = {}
    for i, v in enumerate(ids):
        if i % 3 == 0:
            sets[v] = {"all", "copied", "same"}
        elif i % 10 == 1:
            sets[v] = {f"w{j}" for j in range(rnd.choice([9, 9, 12]))} | {"all"}
        else:
            tags = {f"t{rnd.randrange(25)}" for _ in range(rnd.randrange(0, 6))}
            sets[v] = tags | ({"all"} if rnd.random() < 0.5 else set())
            if rnd.random() < 0.3:
                sets[v] |= {"copied"}
            if rnd.random() < 0.2:
                sets[v] |= {f"w{rnd.randrange(12)}"}
    links = {("0", v) for v in ids[::2]}
    links |= {(rnd.choice(ids), rnd.choice([*ids, "gone"])) for _ in range(60)}
    return sets, links


def _expected_pairs(sets):
    counts = {}
    for a, b in combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if n:
            counts[a, b] = counts[b, a] = n
    return counts


@pytest.mark.parametrize(
    "seed, k, max_width, crowd", [(1, 3, 7, 64), (2, 10, 7, 2), (3, 2, 100, 3), (4, 4, 4, 1), (5, 1, 2, 64)]
)
def test_against_brute_force(spark, monkeypatch, seed, k, max_width, crowd):
    monkeypatch.setattr(recommend, "CROWD", crowd)
    sets, links = _catalogue(seed)
    tags = spark.createDataFrame(
        [(v, t) for v, ts in sets.items() for t in sorted(ts)], "video_id string, tag string"
    )
    related = spark.createDataFrame(
        sorted(links), "source_video_id string, related_video_id string"
    )
    counts = _expected_pairs(sets)

    best = {}
    for (a, b), n in counts.items():
        best.setdefault(a, []).append((-n, b))
    want = {(a, b, -n) for a, xs in best.items() for n, b in sorted(xs)[:k]}
    got = recommend.common_tag_pairs(tags, k, max_width).collect()
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want

    scored = {}
    for a, b in set(counts) | links:
        n, r = counts.get((a, b), 0), (a, b) in links
        scored.setdefault(a, []).append((-(5 * r + 3 * n), b))
    want_lists = {a: [(b, -float(s)) for s, b in sorted(xs)[:k]] for a, xs in scored.items()}
    lists = recommend.watch_next(tags, related, k, max_width=max_width)
    staged = recommend.nest(
        recommend.top_k(recommend.score(recommend.candidates(related, tags, k, max_width)), k)
    )
    assert sorted(map(str, lists.collect())) == sorted(map(str, staged.collect()))
    assert {
        r["_id"]: [(x["video_id"], x["score"]) for x in r["recommendations"]]
        for r in lists.collect()
    } == {a: xs for a, xs in want_lists.items()}


def test_linked_counts_are_exact(spark):
    sets, links = _catalogue(7)
    tags = spark.createDataFrame(
        [(v, t) for v, ts in sets.items() for t in sorted(ts)], "video_id string, tag string"
    )
    related = spark.createDataFrame(
        sorted(links), "source_video_id string, related_video_id string"
    )
    counts = _expected_pairs(sets)
    got = {tuple(r) for r in recommend.related_tag_counts(related, tags).collect()}
    assert got == {(a, b, counts.get((a, b), 0)) for a, b in links}


@pytest.mark.parametrize("spare", [0, 1])
def test_ids_not_sent_with_a_tags_share_are_fetched(spark, monkeypatch, spare):
    """Tag ``low`` alone holds the smallest ids, so talks of more tags lack some of its share."""
    monkeypatch.setattr(recommend, "SPARE", spare)
    sets = {f"a{i:02d}": {"low"} for i in range(8)} | {f"z{i:02d}": {"high"} for i in range(8)}
    sets |= {"m1": {"low", "high", "other", "alone"}, "m2": {"low", "other"}, "m3": {"low", "high"}}
    tags = spark.createDataFrame(
        [(v, t) for v, ts in sets.items() for t in sorted(ts)], "video_id string, tag string"
    )
    k = 5
    stored, heads = recommend._tag_sets(tags, k + 1)
    lists = {r["video_id"]: r for r in stored.collect()}
    assert "low" in [e["tag"] for e in lists["m1"]["lacking"]]
    assert not lists["a00"]["lacking"]
    whole = {r["video_id"]: r["head"] for r in recommend._whole_heads(stored, heads, k + 1).collect()}
    assert whole["m1"] == ["a00", "a01", "a02", "a03", "a04", "a05"]

    best = {}
    for (a, b), n in _expected_pairs(sets).items():
        best.setdefault(a, []).append((-n, b))
    want = {(a, b, -n) for a, xs in best.items() for n, b in sorted(xs)[:k]}
    assert {tuple(r) for r in recommend.common_tag_pairs(tags, k).collect()} == want


def test_partners_are_not_shuffled_by_pair(spark):
    """Links known among the partners need no shuffle of all pairs; repeated links stay one row."""
    sets, links = _catalogue(7)
    tags = spark.createDataFrame(
        [(v, t) for v, ts in sets.items() for t in sorted(ts)], "video_id string, tag string"
    )
    related = spark.createDataFrame(
        sorted(links) * 2, "source_video_id string, related_video_id string"
    )
    pairs = recommend.candidates(related, tags, 4)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(source_video_id#\d+L?, candidate_video_id", plan)
    rows = pairs.collect()
    counts = _expected_pairs(sets)
    assert len({(r[0], r[1]) for r in rows}) == len(rows)
    assert {(r[0], r[1], r[3]) for r in rows if r["is_related"]} == {
        (a, b, counts.get((a, b), 0)) for a, b in links
    }
    assert all(r[3] == counts[r[0], r[1]] and (r[0], r[1]) not in links for r in rows if not r["is_related"])


@pytest.mark.parametrize("seed, max_width, block", [(1, 32, 256), (2, 7, 5), (3, 2, 16)])
def test_candidates_hold_every_partner(spark, monkeypatch, seed, max_width, block):
    """Talks have far more than ten partners, and links to partners, strangers and themselves."""
    monkeypatch.setattr(recommend, "BLOCK", block)
    sets, links = _catalogue(seed)
    links |= {("1", "1"), ("gone", "0")}
    tags = spark.createDataFrame(
        [(v, t) for v, ts in sets.items() for t in sorted(ts)], "video_id string, tag string"
    )
    related = spark.createDataFrame(
        sorted(links) * 2, "source_video_id string, related_video_id string"
    )
    counts = _expected_pairs(sets)
    want = {(a, b, int((a, b) in links), counts.get((a, b), 0)) for a, b in set(counts) | links}
    pairs = recommend.candidates(related, tags, max_width=max_width)
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(want)
    assert set(got) == want
    if max_width == 32:
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\((source_video_id|a)#\d+L?, (candidate_video_id|b)", plan)


@pytest.mark.parametrize("max_width, block", [(32, 256), (7, 5)])
def test_common_tag_pairs_hold_every_pair(spark, monkeypatch, max_width, block):
    monkeypatch.setattr(recommend, "BLOCK", block)
    sets, _ = _catalogue(4)
    tags = spark.createDataFrame(
        [(v, t) for v, ts in sets.items() for t in sorted(ts)], "video_id string, tag string"
    )
    want = sorted((a, b, n) for (a, b), n in _expected_pairs(sets).items())
    assert max(sum(a == v for a, _, _ in want) for v in sets) > recommend.MAX_RECOMMENDATIONS
    assert sorted(map(tuple, recommend.common_tag_pairs(tags, max_width=max_width).collect())) == want

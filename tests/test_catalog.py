"""Reading, cleaning, profiles, lookups and searches on the hand-made catalog."""

import pytest

from talkloom.operators import catalog, lookup, paths, recommend, search
from talkloom.plans import jobs
from talkloom.sources.files import read_catalog, read_collection, write_collection

TALKS = [("1", "s1", "Ann É", "Talk 1", "u1")] * 2 + [
    (i, f"s{i}", "Ann é" if i == "2" else "Bob", f"Talk {i}", f"u{i}") for i in "234"
]
TAGS = [("1", "a"), ("1", "b"), ("2", "a"), ("2", "b"), ("3", "b"), ("3", "b"), ("4", None), ("9", "a")]
RELATED = [("1", "3"), ("1", "3"), ("1", "1"), ("4", "8"), ("2", None)]


@pytest.fixture(scope="module")
def frames(spark):
    talks = spark.createDataFrame(
        TALKS, "id string, slug string, speakers string, title string, url string"
    )
    tags = spark.createDataFrame(TAGS, "id string, tag string")
    related = spark.createDataFrame(RELATED, "id string, related_id string")
    return talks, tags, related


@pytest.fixture(scope="module")
def served(spark, frames, tmp_path_factory):
    talks, tags, related = frames
    base = str(tmp_path_factory.mktemp("served"))
    lists = recommend.watch_next(catalog.clean_tags(tags), catalog.clean_related(related))
    write_collection(lists, base, "watch_next")
    write_collection(catalog.talk_profiles(talks, tags), base, "videos")
    return read_collection(spark, base, "watch_next"), read_collection(spark, base, "videos")


def test_profiles(frames):
    talks, tags, _ = frames
    rows = catalog.talk_profiles(talks, tags).orderBy("video_id").collect()
    assert [(r["video_id"], r["tags"]) for r in rows] == [
        ("1", ["a", "b"]), ("2", ["a", "b"]), ("3", ["b"]), ("4", [])
    ]


def test_duplicate_talks_keep_the_smallest(spark):
    rows = [("1", "s", "x", "B", "u"), ("1", "s", "x", "A", "u"), (None, "s", "x", "A", "u")]
    talks = spark.createDataFrame(
        rows, "id string, slug string, speakers string, title string, url string"
    )
    assert [r["title"] for r in catalog.clean_talks(talks).collect()] == ["A"]


def test_details_multiply_talks(spark, frames):
    details = spark.createDataFrame(
        [("1", "d", "9", "p"), ("1", "e", "9", "p")],
        "id string, description string, duration string, publishedAt string",
    )
    got = catalog.enrich_catalog(frames[0], details)
    assert got.columns[-3:] == ["description", "duration", "publishedAt"]
    assert got.count() == 2 * 2 + 3


def test_tag_lists_keep_duplicates(frames):
    rows = {r["_id"]: r["tags"] for r in catalog.tag_lists(frames[1]).collect()}
    assert rows == {"1": ["a", "b"], "2": ["a", "b"], "3": ["b", "b"], "4": [], "9": ["a"]}


def test_resolve(spark, served):
    asked = spark.createDataFrame([("1",), ("4",), ("7",), ("7",), ("",), (None,)], "talk_id string")
    rows = {r["talk_id"]: r for r in lookup.resolve_watch_next(asked, *served).collect()}
    assert sorted(rows) == ["1", "4", "7"]
    assert [x["video_id"] for x in rows["1"]["recommendations"]] == ["3", "2", "1"]
    assert rows["1"]["total"] == 3
    assert rows["1"]["recommendations"][0]["video"]["title"] == "Talk 3"
    assert rows["1"]["recommendations"][0]["reasons"] == ["related_video", "common_tags"]
    assert (rows["4"]["total"], rows["4"]["message"]) == (0, None)
    assert (rows["7"]["total"], rows["7"]["message"]) == (0, "No recommendations found")


def test_get_watch_next_cuts_before_it_drops(spark, served):
    asked = spark.createDataFrame([("1",), ("7",)], "talk_id string")

    def ids(limit):
        rows = lookup.get_watch_next(asked, *served, limit=limit).orderBy("pos").collect()
        return [r["video_id"] for r in rows]

    assert ids(2) == ["3", "2"]
    assert ids(4) == ["3", "2", "1"]
    assert ids(0) == []


def test_single_talks(spark, served):
    assert [r["title"] for r in lookup.get_talk(served[1], "2").collect()] == ["Talk 2"]
    assert lookup.get_talk(served[1], "22").count() == 0
    asked = spark.createDataFrame([("2",), ("2",), ("x",)], "talk_id string")
    assert lookup.get_talks(served[1], asked).count() == 1


def test_searches(served):
    profiles = served[1]
    assert [r["video_id"] for r in search.search_by_tag(profiles, "B").collect()] == ["1", "2", "3"]
    assert [r["video_id"] for r in search.search_by_tag(profiles, "b", 2).collect()] == ["1", "2"]
    found = search.search_by_speaker(profiles, "É$").collect()
    assert [r["video_id"] for r in found] == ["1", "2"]
    assert search.search_by_speaker(profiles, "^nn").count() == 0


def test_tag_paths(frames):
    talks, tags, _ = frames
    args = catalog.clean_talks(talks), catalog.clean_tags(tags)
    rows = {}
    for r in paths.tag_paths(*args).collect():
        assert r["title"] == f"Percorso: {r['_id']}" and r["video_count"] == 3
        rows.setdefault(r["_id"], []).append((r["video_id"], r["video_title"]))
    assert sorted(rows["a"]) == [("1", "Talk 1"), ("2", "Talk 2"), ("9", None)]
    assert sorted(v for v, _ in rows["b"]) == ["1", "2", "3"]
    headers = paths.tag_path_headers(args[1]).collect()
    assert sorted((r["_id"], r["video_count"]) for r in headers) == [("a", 3), ("b", 3)]


@pytest.fixture
def csv_base(tmp_path):
    def put(name, header, rows):
        lines = [header, *[",".join("" if c is None else c for c in r) for r in rows]]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")

    put("final_list", "id,slug,speakers,title,url", [("0012", "s", "Ann", "Talk 1", "u")] + TALKS)
    put("details", "extra,id,description,duration,publishedAt", [("x", "1", "d", "9", "p")])
    put("tags", "id,tag", TAGS + [("3", "a")])
    put("images", "id,image", [("1", "http")])
    put("related_videos", "id,related_id,title", [(*r, "t") for r in RELATED])
    return str(tmp_path)


def test_csv_keeps_ids_as_text(spark, csv_base):
    tables = read_catalog(spark, csv_base)
    assert tables.talks.where("id = '0012'").count() == 1
    assert dict(tables.details.dtypes)["duration"] == "string"
    assert tables.related.columns == ["id", "related_id", "title"]


def test_csv_without_a_needed_column_fails(spark, csv_base):
    with open(f"{csv_base}/tags.csv", "w", encoding="utf-8") as f:
        f.write("id,label\n1,a\n")
    with pytest.raises(ValueError, match="tag"):
        read_catalog(spark, csv_base)


def test_csv_quoted_newlines(spark, csv_base):
    with open(f"{csv_base}/details.csv", "w", encoding="utf-8") as f:
        f.write('id,description,duration,publishedAt\n1,"a ""b""\nc",9,p\n')
    details = read_catalog(spark, csv_base, quoted_newlines=True).details
    assert [r["description"] for r in details.collect()] == ['a "b"\nc']


def test_jobs_are_repeatable(spark, csv_base, tmp_path):
    tables, out = read_catalog(spark, csv_base), str(tmp_path / "out")

    def run():
        counts = jobs.load_catalog(tables, out)
        counts |= jobs.generate_recommendations(tables, out)
        counts |= jobs.create_tag_paths(tables, out)
        summary = jobs.refresh_paths(spark, out).first().asDict()
        names = [*counts, "paths"]
        return counts, summary, {n: sorted(map(str, read_collection(spark, out, n).collect())) for n in names}

    first = run()
    assert first[0]["tedx_videos"] == 5
    assert first[0]["tedx_watch_next"] == 5
    assert first[0]["tag_paths"] == 2
    assert first[0]["tag_path_members"] == 7
    assert first[1] == {
        "speaker_paths": 0, "topic_paths": 0, "total_paths": 0, "videos_analyzed": 5
    }
    assert run() == first


def test_refresh_needs_talks(spark, tmp_path, frames):
    base = str(tmp_path)
    talks, tags, _ = frames
    write_collection(catalog.talk_profiles(talks.limit(0), tags), base, "tedx_videos")
    with pytest.raises(ValueError):
        jobs.refresh_paths(spark, base)


def test_doubled_quotes_without_newlines(spark, csv_base):
    with open(f"{csv_base}/details.csv", "w", encoding="utf-8") as f:
        f.write('id,description,duration,publishedAt\n1,"a ""b"", c",9,p\n')
    assert [r["description"] for r in read_catalog(spark, csv_base).details.collect()] == ['a "b", c']


def test_results_do_not_depend_on_partitions(spark, frames):
    talks, tags, _ = frames
    setting = "spark.sql.shuffle.partitions"
    before, seen = spark.conf.get(setting), []
    try:
        for n in (1, 8, 64):
            spark.conf.set(setting, n)
            spread = [df.repartition(n) for df in (talks, tags)]
            members = paths.tag_paths(catalog.clean_talks(spread[0]), catalog.clean_tags(spread[1]))
            rows = [*catalog.talk_profiles(*spread).collect(), *members.collect()]
            seen.append(sorted(map(str, rows)))
    finally:
        spark.conf.set(setting, before)
    assert seen[0] == seen[1] == seen[2]

"""Byte and word repeats and near duplicates against their direct definitions."""

import random

import brute_force
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkloom.llm import anchors, components, forest, passages, suffixes

SF = "/root/testdata/sf0.001"


def _pairs(docs):
    return [(r[0], r[1]) for r in docs.where("doc_id is not null").dropDuplicates().select("doc_id", "text").collect()]


def _unique(docs):
    return docs.where("doc_id is not null").dropDuplicates(["doc_id"])


@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array(symbols):
    assert suffixes.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_suffix_array_of_nothing():
    assert suffixes.suffix_array([]) == []


@given(st.lists(st.text("ab", max_size=12), max_size=4), st.text("ab", max_size=15))
@settings(max_examples=200, deadline=None)
def test_matching_statistics(references, text):
    automaton = passages.SuffixAutomaton()
    for reference in references:
        automaton.add(list(reference))
    want = [
        max((n for n in range(i + 2) if any(text[i + 1 - n : i + 1] in r for r in references)), default=0)
        for i in range(len(text))
    ]
    assert automaton.matches(list(text)) == want


def _bytes(docs, store):
    rows = suffixes.digests(suffixes.repeated_bytes(docs, store)).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}


def _words(docs, store):
    rows = passages.digests(passages.repeated_words(docs, store)).collect()
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows}


def _near(docs, store):
    rows = forest.near_duplicates(docs, store).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_documents(spark, store):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = _pairs(docs)
    assert _bytes(docs, store) == brute_force.repeated_bytes(plain)
    assert _words(docs, store) == brute_force.repeated_words(plain)
    assert _near(docs, store) == brute_force.near_duplicates(plain)


def test_edge_cases(edge_docs, store):
    docs = _unique(edge_docs)
    plain = _pairs(docs)
    assert _bytes(docs, store) == brute_force.repeated_bytes(plain)
    assert _words(docs, store) == brute_force.repeated_words(plain)
    assert _near(docs, store) == brute_force.near_duplicates(plain)


def test_repeated_and_null_ids_keep_their_rows(edge_docs, store):
    n = edge_docs.count()
    rows = suffixes.digests(suffixes.repeated_bytes(edge_docs, store)).collect()
    assert len(rows) == n
    # a null id comes last, so its copy of document 1 goes
    null_rows = [r for r in rows if r["doc_id"] is None and r["n_bytes"]]
    assert [r["n_removed"] for r in null_rows] == [null_rows[0]["n_bytes"]]
    assert passages.digests(passages.repeated_words(edge_docs, store)).count() == n
    near = forest.near_duplicates(edge_docs, store).collect()
    assert len(near) == n
    assert {r["component_id"] for r in near if r["doc_id"] is None} == {1, None}


def test_one_of_each_group_stays_with_all_columns(edge_docs, store):
    left = forest.deduplicated(edge_docs, store)
    assert left.columns == edge_docs.columns
    ids = sorted(r["doc_id"] for r in left.select("doc_id").collect() if r["doc_id"] is not None)
    assert ids == [1, 4, 5, 6, 7, 9, 10, 12, 14, 15]


def test_texts_of_one_id_are_told_apart_by_more_than_32_bits(spark, store):
    words = [f"w{i}" for i in range(100_000)]
    texts = spark.createDataFrame([(" ".join(words[i : i + 9]),) for i in range(90_000)], "text string")
    pair = texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("both"))
    one, two = pair.where("size(both) > 1").first()["both"][:2]
    docs = spark.createDataFrame([(None, one), (None, two)], "doc_id long, text string")
    assert {r["text"] for r in forest.deduplicated(docs, store).collect()} == {one, two}
    long = " ".join(words[:60])
    docs = spark.createDataFrame([(1, long), (None, one), (None, two + " " + long)], "doc_id long, text string")
    left = {r["text"].split()[0]: r["text"] for r in passages.cleaned(passages.repeated_words(docs, store)).collect()}
    assert one in left.values() and long in left.values()


def test_one_of_near_copies_with_null_or_shared_ids_stays(spark, store):
    base = [f"b{i}" for i in range(100)]
    rows = [(doc, " ".join([*base[:-1], f"x{i}"])) for i, doc in enumerate([None, None, 7, 7, 9])]
    apart = [(None, " ".join(f"c{i}{n}" for i in range(50))) for n in "ab"]
    docs = spark.createDataFrame([*rows, *apart], "doc_id long, text string")
    left = [r["doc_id"] for r in forest.deduplicated(docs, store).collect()]
    assert sorted(left, key=str) == [7, None, None]
    only_null = spark.createDataFrame([(None, text) for _, text in rows], "doc_id long, text string")
    assert forest.deduplicated(only_null, store).count() == 1


def test_empty_tables(no_docs, store):
    assert suffixes.digests(suffixes.repeated_bytes(no_docs, store)).count() == 0
    assert passages.cleaned(passages.repeated_words(no_docs, store)).count() == 0
    assert forest.deduplicated(no_docs, store).count() == 0


def test_text_without_passages():
    text = b"a b  c\nd e"
    assert passages.without(text, [(1, 3)]) == b"a d e"
    assert passages.without(text, [(3, 5)]) == b"a b  c"
    assert passages.without(text, []) == text
    assert passages.without(text, [(0, 5)]) == b""


def test_crowded_anchors_count_every_window(spark, store, monkeypatch):
    """A passage in many documents, each with its own words around it."""
    rng = random.Random(3)
    passage = " ".join(f"shared{i}" for i in range(30))
    rows = []
    for i in range(40):
        own = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(20)) for _ in range(2)]
        rows.append((i, f"{own[0]} {passage} {own[1]}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(anchors, "MOST_CLASSES", 3)
    assert _bytes(docs, store) == brute_force.repeated_bytes(rows)
    assert _words(docs, store) == brute_force.repeated_words(rows)


def test_a_passage_in_a_third_of_all_documents(spark, store, monkeypatch):
    """The hot class is broadcast, shuffled, or one of both kinds: the result is the same."""
    rng = random.Random(5)
    passage = " ".join(f"shared{i}" for i in range(30))
    rows = []
    for i in range(90):
        own = " ".join(f"v{rng.randrange(200)}" for _ in range(40))
        rows.append((i, f"{own} {passage}" if i % 3 == 0 else own if i % 7 else f"{rows[-1][1]} end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (1, 8, 1_024):
        monkeypatch.setattr(anchors, "HOT_CLASSES", most)
        assert _words(docs, store) == brute_force.repeated_words(rows)
    monkeypatch.setattr(anchors, "HOT_CLASSES", 8)
    assert _bytes(docs, store) == brute_force.repeated_bytes(rows)


def test_star_of_near_copies(spark, store):
    """Copies that are similar to their original, and too different from each other."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    rows = [(500, " ".join(base))]
    for i in range(120):
        copy = list(base)
        for at in rng.sample(range(300), 7):
            copy[at] = f"n{rng.randrange(10**6)}"
        rows.append((i + (i >= 60) * 1000, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _near(docs, store) == brute_force.near_duplicates(rows)


def test_families_with_much_text_in_common(spark, store):
    """Many pairs of similar documents; all share a text that does not make them similar."""
    rng = random.Random(7)
    common = [f"c{i}" for i in range(500)]
    rows = []
    for family in range(250):
        own = [f"f{family}x{i}" for i in range(25)]
        for member in range(2):
            rest = [f"r{family}x{member}x{i}" for i in range(80)]
            rows.append((2 * family + member, " ".join(common + own + rest)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # of 601 shingles the members of a family share 521, all others 496
    assert _near(docs, store) == {i: (601, i - i % 2) for i, _ in rows}


def test_links_that_no_tree_shows_are_found(spark, store, monkeypatch):
    monkeypatch.setattr(forest, "LEAST_AGREE", forest.SIGNATURE + 1)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert _near(docs, store) == brute_force.near_duplicates(_pairs(docs))


def test_crowded_orders_go_on_through_further_minima(spark, store):
    rows = [(bytes([i, 0]), bytes(4 * forest.SIGNATURE - 1) + bytes([i % 7])) for i in range(40)]
    found = forest._regions(spark.createDataFrame(rows, "cls binary, signature binary"), store)[1]
    last = forest.TREES - 1
    for row in found.where(f"tree < {last}").collect():
        assert len(row["deeper"]) == 4 * (forest.SIGNATURE - forest.DEPTH)


def test_components_of_a_chain(spark, store):
    n = 200
    edges = spark.range(n - 1).selectExpr("id as a", "id + 1 as b")
    found = components.components(edges, store).collect()
    assert {r["component"] for r in found} == {0} and len(found) == n


def test_unlinked_nodes_have_no_component(spark, store):
    edges = spark.createDataFrame([(3, 3)], "a long, b long")
    assert components.components(edges, store).count() == 0

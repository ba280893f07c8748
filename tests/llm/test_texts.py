"""Rule statistics, quality, extraction, tokens, mixing and shards."""

import hashlib
import zlib

import brute_force
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from talkloom.llm import html, mixing, quality, quantiles, rules, sharding, tokenize

SF = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _statistics(docs):
    rows = rules.text_statistics(docs).collect()
    return sorted(tuple(str(r[c]) for c in ["doc_id", *rules.STATISTICS]) for r in rows)


def test_rule_statistics(spark, edge_docs):
    for docs in (edge_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        plain = docs.select("doc_id", "text").collect()
        want = sorted(tuple(map(str, (r[0], *brute_force.rule_statistics(r[1])))) for r in plain)
        assert _statistics(docs) == want


def _held_out(spark, keep_of):
    """Shares of good and bad rows kept, of labelled rows that were not used to fit."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fit = labels.where("doc_id % 2 = 0")
    rest = labels.where("doc_id % 2 = 1").toPandas()
    kept = keep_of(docs, fit)
    joined = rest.merge(kept, on="doc_id")
    return joined.groupby("quality")["kept"].mean()


def test_forest_on_held_out_labels(spark):
    share = _held_out(
        spark,
        lambda docs, fit: rules.quality_rules(docs, rules.fit_on_sample(docs, fit))
        .select("doc_id", "kept").toPandas(),
    )
    assert share[1] > 0.93 and share[0] < 0.25


def test_classifier_on_held_out_labels(spark, store):
    def kept(docs, fit):
        fitted = quality.fit_sites(docs, fit, lambda df: store(df, "sites"))
        return quality.classify(docs, fitted).select("row.doc_id", "kept").toPandas()

    share = _held_out(spark, kept)
    assert share[1] > 0.95 and share[0] < 0.15


def test_quality_edge_cases(spark, edge_docs, no_docs, store):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (15, 0), (None, 1), (2, None), (1, 1)], none.schema)
    keep = lambda df: store(df, "sites")
    for labels in (none, some):
        fitted = quality.fit_sites(edge_docs, labels, keep)
        rows = quality.classify(edge_docs, fitted)
        assert rows.count() == edge_docs.count()
        assert rows.select("row.*").columns == edge_docs.columns
        forest = rules.fit_on_sample(edge_docs, labels)
        verdicts = rules.quality_rules(edge_docs, forest).collect()
        assert len(verdicts) == edge_docs.count()
        assert not any(r["kept"] for r in verdicts if r["base_failed"])
    unfitted = quality.fit_sites(edge_docs, none, keep)
    assert quality.classify(edge_docs, unfitted).where("not kept").count() == 0
    assert quality.classify(no_docs, quality.fit_sites(no_docs, some, keep)).count() == 0


def test_models_and_thresholds_come_from_every_label(spark, store):
    # few are bad; a hash of the key would leave most of them out of a bounded sample
    docs = spark.range(40_000).selectExpr(
        "id as doc_id", "'s' as source", "'en' as lang",
        "concat_ws(' ', transform(sequence(1, 12), i -> concat('w', i + id % 50)),"
        " if(id % 4000 = 7, repeat('# ', 60), '')) as text",
    )
    labels = docs.selectExpr("doc_id", "if(doc_id % 4000 = 7, 0, 1) as quality")
    rows = rules.labelled_features(docs, labels, "quality")
    assert rows.count() == 40_000 and rows.where("not good").count() == 10
    model = quality.fit_sites(docs, labels, lambda df: store(df, "sites")).model
    assert abs(model.prior - np.log(39_990.5 / 10.5)) < 1e-9


def test_quantiles_are_exact(spark):
    values = np.random.default_rng(3).normal(size=20_000).round(3)
    values[:9_000] = values[0]
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    for share in (0.0, 0.004, 0.37, 0.5, 1.0):
        assert quantiles.quantile(rows, F.col("x"), share, 20_000) == float(np.quantile(values, share))


def test_sparse_sites_stay_near_their_parents(spark):
    paths = spark.createDataFrame(
        [("h1", "a", 100_000, 90_000.0), ("h1", "b", 1, 0.0), ("h2", "a", 100_000, 10_000.0), (None, None, 2, 2.0)],
        "host string, path string, n long, good double",
    )
    found = {(r["host"], r["path"]): r["posterior"] for r in quality.site_posteriors(paths).collect()}
    assert abs(found["h1", "a"] - 0.9) < 0.01 and abs(found["h2", "a"] - 0.1) < 0.01
    assert 0.3 < found["h1", "b"] < 0.9  # one document cannot undo its host
    assert (None, None) in found


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body><header>Site <a href=/>Home</a></header><nav><ul><li><a href="/x">Menu one</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><p>First  <b>bold</b>
text.<p>Second&nbsp;block &lt;here&gt;<aside>Side bar</aside><div class="ad">Buy now</div>
<form><input>Name</form><p>Third<br>line<!-- gone --></article><section id="comments"><p>Nice read</p>
</section><footer>&copy; 2020</footer>"""


def test_page_without_furniture():
    assert html.main_text(PAGE, html.Weights()) == (
        "A & B\nFirst bold text.\nSecond block <here>\nThird line"
    )


@pytest.mark.parametrize("page", ["", "<", "<p", "</div></div>", "<!--", "<script>x", "<a b='", "\x00<p>\x00"])
def test_broken_pages(page):
    assert isinstance(html.main_text(page, html.Weights()), str)


def test_best_run():
    assert html.best_run([]) == (0, 0)
    assert html.best_run([-1.0, -2.0]) == (0, 0)
    assert html.best_run([-1.0, 3.0, -1.0, 2.0, -5.0, 4.0]) == (1, 4)
    for seed in range(50):
        row = np.random.default_rng(seed).integers(-3, 4, 20).astype(float).tolist()
        a, b = html.best_run(row)
        best = max(sum(row[i:j]) for i in range(20) for j in range(i, 21))
        assert sum(row[a:b]) == max(best, 0)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = html.extract_text(pages, html.fit_weights(pages)).collect()
    assert len(rows) == pages.count()
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in rows:
        inner = sources[row["page_id"]].split("<article>")[1].split("</article>")[0]
        words = " ".join(html.references.unescape(html.re.sub(r"<[^>]*>", " ", inner)).split())
        assert " ".join(row["text"].split()) == words and row["n_chars"] == len(row["text"])


def test_page_table_edge_cases(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<p>a b c", "x"), (2, "u", "<p>a b c", "x")],
        "page_id long, url string, html string, text string",
    )
    rows = html.extract_text(pages, html.fit_weights(pages)).collect()
    assert sorted(r["text"] for r in rows) == ["", "", "a b c", "a b c"]
    assert html.extract_text(pages.where("false"), html.fit_weights(pages.where("false"))).count() == 0


def test_tokens_round_trip(spark, edge_docs, no_docs):
    with open(RANKS, "rb") as file:
        ranks = {tokenize.base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = tokenize.token_digests(edge_docs, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    plain = edge_docs.select("doc_id", "text").collect()
    want = []
    for doc, text in plain:
        ids = whole.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((str(doc), ids, digest, hashlib.sha256((text or "").encode()).hexdigest()))
    rows = [(str(r["doc_id"]), r["ids"], r["ids_sha256"], r["decoded_sha256"]) for r in got]
    assert sorted(rows) == sorted(want)
    ids = tokenize.encode_texts(edge_docs, RANKS, public_tokenizers.PATTERN)
    back = tokenize.decode_ids(ids, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["bytes"]) for r in back) == sorted((t or "").encode() for _, t in plain)
    assert tokenize.token_digests(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_texts_are_cut_at_safe_places():
    tokenizer = tokenize.encoding(RANKS, public_tokenizers.PATTERN)
    text = "It's  a\n\n test, 12 3\tof   cuts …  é's x \n" * 40
    for size in (1, 2, 3, 7, 50):
        assert "".join(tokenize.safe_parts(text, size)) == text
        assert tokenize.encode(tokenizer, text, size) == tokenizer.encode_ordinary(text)


def _mixed(docs):
    return mixing.sampled(docs).collect()


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source", "text")
    rows = _mixed(docs)
    assert len(rows) == docs.count()
    largest = {}
    taken, target = {}, {}
    for r in rows:
        s = r["source"]
        taken[s] = taken.get(s, 0) + r["copies"] * r["size"]
        target[s] = r["target"]
        largest[s] = max(largest.get(s, 0), r["size"])
        assert 0 <= r["copies"] <= 3
    assert abs(sum(target.values()) - sum(r["size"] for r in rows)) < 1e-3
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in taken)


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame(
        [("a", 10), ("b", 1000), ("c", 10), (None, 5), ("z", 0)], "source string, size long"
    )
    found = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # weights a 1, b 2, c 3, z 1, null 2; a, c, null and z are capped and b takes the rest
    assert found == {"a": 30.0, "b": 1025.0 - 75.0, "c": 30.0, None: 15.0, "z": 0.0}


def test_mix_edge_cases(edge_docs, no_docs):
    rows = _mixed(edge_docs)
    assert len(rows) == edge_docs.count()
    assert mixing.mix(edge_docs).columns == edge_docs.columns
    assert sum(r["copies"] for r in rows) == mixing.mix(edge_docs).count()
    assert _mixed(no_docs) == [] and mixing.mix(no_docs).count() == 0
    assert sorted(map(str, rows)) == sorted(map(str, _mixed(edge_docs.repartition(7))))


def test_rows_without_an_id_are_spread_over_blocks(spark):
    """A third of the rows have no id and all are of one size: the blocks stay small."""
    rows = [(i if i % 3 else None, "s", f"one w{i}") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    salted = docs.select(mixing._row_hash("doc_id", "text").alias("h"))
    salt = F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint") % mixing.spread_of(len(rows))
    sizes = [r["count"] for r in salted.groupBy(salt).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * len(rows) / 16
    drawn = _mixed(docs)
    assert len(drawn) == len(rows) and all(r["copies"] == 1 for r in drawn)
    assert sorted(map(str, drawn)) == sorted(map(str, _mixed(docs.repartition(5))))


def test_blocks_grow_with_the_root_of_the_rows(edge_docs):
    assert [mixing.spread_of(n) for n in (0, 10_000, 10**6, 10**10)] == [16, 16, 50, 5_000]
    few, many = (mixing.sampled(edge_docs, spread=n) for n in (1, 1_000))
    assert few.count() == many.count() == edge_docs.count()


def test_shards(edge_docs, no_docs, store):
    keep = lambda df: store(df, "slot-map")
    rows = sharding.shard(edge_docs, keep, 3).collect()
    plain = edge_docs.select("doc_id", "text").collect()
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in plain)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    for shard in range(3):
        places = sorted(r["place"] for r in rows if r["shard"] == shard)
        assert places == list(range(len(places)))
    assert sharding.shard(no_docs, keep, 3).count() == 0


def test_shard_bytes_are_near_equal(spark, store):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs, lambda df: store(df, "slot-map")).groupBy("shard").sum("size").collect()
    loads = [r[1] for r in rows]
    assert len(loads) == 8 and max(loads) - min(loads) < 0.01 * sum(loads) / 8


def test_map_versions(spark):
    load = {slot: 1 + slot % 5 for slot in range(256)}
    old = sharding.rebalanced(sharding.first_map(4, 256), load, 4)
    new = sharding.rebalanced(old, load, 5)
    table = sharding.map_table(spark, {1: old, 2: new})
    assert {r["slot"]: r["shard"] for r in sharding.read_map(table).collect()} == new
    assert {r["slot"]: r["shard"] for r in sharding.read_map(table, 1).collect()} == old
    loads = [sum(load[s] for s in new if new[s] == shard) for shard in range(5)]
    assert max(loads) - min(loads) <= 5
    assert sum(old[s] != new[s] for s in old) < 256 / 3


def test_one_id_of_very_many_rows_is_spread_over_slots(spark, store):
    """A third of the rows have a null id, a tenth are equal."""
    rows = [(i, f"text {i}") for i in range(1100)] + [(None, f"other {i}") for i in range(700)]
    rows += [(None, "equal")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard(docs, lambda df: store(df, "slot-map")).collect()
    assert sorted(r["size"] for r in found) == sorted(len(t) + 1 for _, t in rows)
    slots = {r["virtual_slot"] for r in found if r["doc_id"] is None}
    assert len(slots) > 600
    loads = [sum(r["size"] for r in found if r["shard"] == s) for s in range(8)]
    assert max(loads) < 1.1 * sum(loads) / 8
    for s in range(8):
        places = sorted(r["place"] for r in found if r["shard"] == s)
        assert places == list(range(len(places)))


def test_wrappers_with_names_of_furniture_keep_the_article():
    weights = html.Weights()
    text = "<p>" + "word " * 50 + "</p>"
    side = '<div class="sidebar"><p>side words here</p></div>'
    for before, after in [
        ('<div class="layout has-sidebar">', "</div>"),
        ('<div class="elementor-widget">', "</div>"),
        ('<form id="aspnetForm">', "</form>"),
    ]:
        for page in (f"{before}{text}{side}{after}", f"{before}<article>{text}</article>{side}{after}"):
            assert html.main_text(f"<html><body>{page}</body></html>", weights) == ("word " * 50).strip()
    block = '<div class="article-header"><h1>The news of today</h1></div>'
    found = html.main_text(f"<body><article>{block}{text}</article>{side}</body>", weights)
    assert found == "The news of today\n" + ("word " * 50).strip()
    form = "<form><p>your name</p></form>"
    assert "name" not in html.main_text(f"<body><article>{text}{form}</article></body>", weights)


def test_page_cut_off_in_a_long_tag():
    """Time does not grow with the ways to read the quotes of a tag without an end."""
    import time

    for tail in ["<div " + 'a="b" ' * 1000, "<div " + "a='b\" " * 1000, "<p " + '"' * 3000, "<div " + "a/" * 3000]:
        start = time.perf_counter()
        assert html.main_text("<article><p>one two</p></article>" + tail, html.Weights()).startswith("one two")
        assert time.perf_counter() - start < 1
    page = "<p title='a > b'>one and one and one</p><img src=\"x>y\"/><p class=it's>two and two and two</p>"
    assert html.main_text(page, html.Weights()) == "one and one and one\ntwo and two and two"


def test_articles_use_names_of_furniture_too():
    kept = [
        '<section id="related-work"><h2>Other</h2><p>Some prose of others.</p></section>',
        '<p class="notice-board">On the board.</p>', '<div class="search">The long search for words.</div>',
        '<blockquote class="share-quote">A quote.</blockquote>', '<p class="widget">About widgets.</p>',
    ]
    gone = [
        '<div class="ad">Buy this</div>', '<div class="share"><a href="x">Tweet</a> <a href="y">Mail</a></div>',
        '<div class="search"><input name="q">Find</div>', '<div class="comments"><p>First!</p></div>',
    ]
    story = "<p>" + "The story goes on and on. " * 20 + "</p>"
    for part in [*kept, *gone]:
        text = html.main_text(f"<body><nav>Menu</nav><article>{story}{part}{story}</article></body>", html.Weights())
        assert (text.count("\n") >= 2) == (part in kept), part


def test_main_with_an_article_is_labelled():
    page = "<main><div class='lead'>Top</div><article><p>Body of it</p></article><p>After</p></main>"
    counts = html.kind_counts(page)
    assert counts["word p", True] == 3 and counts["word p", False] == 1


def test_references_are_decoded_before_parts_are_joined():
    page = "<p>a &am<b>p;</b> b &amp; c</p>"
    assert html.main_text(page, html.Weights()) == "a &amp; b & c"


def test_very_many_equal_records_are_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 1_000)
    docs = spark.range(30_000).selectExpr("case when id < 25500 then 1 else id end as doc_id", "'same' as text")
    records = sharding.records_of(docs)
    assert records.count() == 30_000
    hot = records.where("doc_id = 1").groupBy("virtual_slot").count()
    assert hot.agg(F.max("count")).first()[0] < 60
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    by_task = records.where("doc_id = 1").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(by_task) > 1 and sum(r["count"] for r in by_task) == 25_500

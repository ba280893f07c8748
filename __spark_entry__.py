"""

Nested results are flattened, so that both engines give the same plain columns.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators import catalog, lookup, paths, recommend, search, stats
from talkloom.plans import jobs
from talkloom.sources import bindings
from talkloom.sources.files import clustered, read_collection, write_bucketed
from talkloom.sources.scratch import keep, scratch_dir, use_when_unset

try:
    import corpus_pipeline
    from talkloom.llm import queries as llm
except ModuleNotFoundError:
    # the folder, or a module that only it needs, may be left out
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
_HERE = os.path.dirname(os.path.abspath(__file__))
use_when_unset("/tmp/checkpoints/talkloom")
ASKED_TALK = "17"
ASKED_USER = "17"
ASKED_TAG = "PART-17"
ASKED_SPEAKER = "customer#0+1?7$"
ASKED_WORD = "urgent"
#: the fewest buckets, for the small test tables, and the talks that one more is added for
BUCKETS = 8
TALKS_A_BUCKET = 50_000


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the ten best recommendations of every talk."""
    return _top_recommendations(spark, SMOKE_DIR)


def _orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    tables = bindings.orders_catalog(spark, sf)
    return catalog.clean_tags(tables.tags), catalog.clean_related(tables.related)


def _buckets(spark: SparkSession, sf: str) -> int:
    """How many buckets the stored lists and profiles have: one more with every so many orders.

    Parquet files know their number of rows, so nothing is read for it.
    """
    talks = spark.read.parquet(f"{sf}/orders.parquet").count()
    return max(BUCKETS, -(-talks // TALKS_A_BUCKET))


_written: dict[tuple, DataFrame] = {}


def _stored(
    spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame], buckets_by: str | None = None
) -> DataFrame:
    """A collection written once for each session and folder, as the jobs do, then read.

    ``buckets_by``: dealt to buckets by this key, for joins.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _written:
        if buckets_by:
            table = f"{name}_{uuid4().hex}".replace("-", "_")
            path = f"{scratch_dir(spark)}/{table}"
            _written[key] = write_bucketed(build(), path, table, buckets_by, _buckets(spark, sf))
        else:
            _written[key] = keep(build(), name)
    return _written[key]


def _orders_profiles(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        tables = bindings.orders_catalog(spark, sf)
        return catalog.talk_profiles(tables.talks, tables.tags)

    return _stored(spark, sf, "videos", build, "video_id")


def _orders_tag_index(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        return clustered(search.tag_index(_orders_profiles(spark, sf)), "tag")

    return _stored(spark, sf, "video-tags", build)


def _orders_lists(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        return recommend.watch_next(*_orders(spark, sf))

    return _stored(spark, sf, "watch-next", build, "_id")


def _documents_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Written first, as paths are built from the stored profiles and read them often."""

    def build() -> DataFrame:
        tables = bindings.documents_catalog(spark, sf)
        return catalog.talk_profiles(tables.talks, tables.tags)

    return _stored(spark, sf, "document-videos", build)


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every order, and every customer as an id that no talk has."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    unknown = F.concat(F.lit("c-"), F.col("c_custkey").cast("string"))
    return orders.select(F.col("o_orderkey").cast("string").alias("talk_id")).unionByName(
        customer.select(unknown.alias("talk_id"))
    )


def _joined(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


def _enrich_catalog(spark: SparkSession, sf: str) -> DataFrame:
    tables = bindings.orders_catalog(spark, sf)
    return catalog.enrich_catalog(tables.talks, tables.details)


def _tag_lists(spark: SparkSession, sf: str) -> DataFrame:
    lists = catalog.tag_lists(bindings.orders_catalog(spark, sf).tags)
    return lists.select(
        F.col("_id").alias("video_id"),
        _joined("tags"),
        F.size("tags").cast("bigint").alias("n_tags"),
    )


def _clean_talks(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.clean_talks(bindings.orders_catalog(spark, sf).talks)


def _talk_profiles(spark: SparkSession, sf: str) -> DataFrame:
    tables = bindings.orders_catalog(spark, sf)
    return catalog.talk_profiles(tables.talks, tables.tags).withColumn("tags", _joined("tags"))


def _common_tag_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.common_tag_pairs(_orders(spark, sf)[0])


def _related_tag_counts(spark: SparkSession, sf: str) -> DataFrame:
    tags, related = _orders(spark, sf)
    return recommend.related_tag_counts(related, tags)


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    tags, related = _orders(spark, sf)
    pairs = recommend.candidates(related, tags)
    return pairs.withColumn("is_related", F.col("is_related").cast("bigint"))


def _scored_candidates(spark: SparkSession, sf: str) -> DataFrame:
    tags, related = _orders(spark, sf)
    scored = recommend.score(
        recommend.candidates(related, tags, recommend.MAX_RECOMMENDATIONS)
    )
    return scored.withColumns(
        {"is_related": F.col("is_related").cast("bigint"), "reasons": _joined("reasons")}
    )


def _top_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    tags, related = _orders(spark, sf)
    best = recommend.candidates(related, tags, recommend.MAX_RECOMMENDATIONS)
    ranked = recommend.top_k(recommend.score(best))
    return ranked.select(
        "source_video_id",
        "candidate_video_id",
        "score",
        F.col("rank").cast("bigint").alias("rank"),
    )


def _watch_next(spark: SparkSession, sf: str) -> DataFrame:
    lists = recommend.watch_next(*_orders(spark, sf))
    return lists.select("_id", F.posexplode("recommendations").alias("pos", "rec")).select(
        "_id",
        F.col("pos").cast("bigint").alias("pos"),
        "rec.video_id",
        "rec.score",
        F.array_join("rec.reasons", ",").alias("reasons"),
    )


def _resolve_watch_next(spark: SparkSession, sf: str) -> DataFrame:
    # of the profiles this query shows the title
    answers = lookup.resolve_watch_next(
        _requests(spark, sf),
        _orders_lists(spark, sf),
        _orders_profiles(spark, sf).select("video_id", "title"),
        buckets=_buckets(spark, sf),
    )
    rows = answers.select(
        "talk_id", "total", "message", F.posexplode_outer("recommendations").alias("pos", "rec")
    )
    return rows.select(
        "talk_id",
        "total",
        "message",
        F.col("pos").cast("bigint").alias("pos"),
        "rec.video_id",
        "rec.score",
        F.array_join("rec.reasons", ",").alias("reasons"),
        F.col("rec.video.title").alias("title"),
    )


def _get_watch_next(spark: SparkSession, sf: str) -> DataFrame:
    rows = lookup.get_watch_next(
        _requests(spark, sf),
        _orders_lists(spark, sf),
        _orders_profiles(spark, sf),
        buckets=_buckets(spark, sf),
    )
    return rows.withColumns(
        {
            "pos": F.col("pos").cast("bigint"),
            "tags": _joined("tags"),
            "reasons": _joined("reasons"),
        }
    )


def _tag_paths(spark: SparkSession, sf: str) -> DataFrame:
    tables = bindings.orders_catalog(spark, sf)
    return paths.tag_paths(catalog.clean_talks(tables.talks), catalog.clean_tags(tables.tags))


def _flat_paths(members: DataFrame) -> DataFrame:
    return members.select("path_id", "title", "type", "video_count", "video_id")


def _clean_copied_talks(spark: SparkSession, sf: str) -> DataFrame:
    """Every third talk twice, the copy with another slug and speaker."""
    talks = bindings.orders_catalog(spark, sf).talks
    copies = talks.where("cast(id as bigint) % 3 = 0").withColumns(
        {"slug": F.reverse("slug"), "speakers": F.concat(F.lit("A "), F.col("speakers"))}
    )
    return catalog.clean_talks(talks.unionByName(copies))


def _speaker_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_paths(paths.speaker_paths(_orders_profiles(spark, sf), unique=True))


def _topic_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_paths(paths.topic_paths(_documents_profiles(spark, sf), unique=True))


def _topic_paths_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_paths(paths.distinct_topic_paths(_documents_profiles(spark, sf), unique=True))


def _build_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_paths(paths.build_paths(_documents_profiles(spark, sf), unique=True))


def _path_summary(spark: SparkSession, sf: str) -> DataFrame:
    profiles = _documents_profiles(spark, sf)
    return paths.path_summary(paths.build_paths(profiles, unique=True), profiles)


def _learning_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.learning_stats(
        bindings.events_progress(spark, sf), bindings.events_quizzes(spark, sf)
    )


def _learning_stats_requested(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a user; most have no record."""
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    return stats.learning_stats(
        bindings.events_progress(spark, sf),
        bindings.events_quizzes(spark, sf),
        customer.select(F.col("c_custkey").alias("userId")),
    )


def _learning_stats_of_one(spark: SparkSession, sf: str) -> DataFrame:
    """One user with records and one without, each by its id."""
    tables = bindings.events_progress(spark, sf), bindings.events_quizzes(spark, sf)
    known = stats.learning_stats(*tables, user_id=ASKED_USER)
    return known.unionByName(stats.learning_stats(*tables, user_id="nobody"))


def _learning_stats_odd(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as progress and quizzes, with long, tiny, huge and unreadable numbers."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    kind = F.col("l_linenumber") % 5
    price = F.col("l_extendedprice")
    number = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.concat(price.cast("string"), F.lit(" s")))
        .when(kind == 2, (price / 7e15).cast("string"))
        .when(kind == 3, (price * 1e9).cast("string"))
        .otherwise((price / 7).cast("string"))
    )
    rows = items.select(
        F.col("l_suppkey").cast("string").alias("userId"),
        F.col("l_partkey").cast("string").alias("talkId"),
        number.alias("progressSeconds"),
        number.alias("score"),
        F.lit(True).alias("watched"),
        F.lit(True).alias("completed"),
    )
    return stats.learning_stats(rows, rows)


def _load_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Write the five collections and read them back: rows as the job counted them and as found."""
    base = f"{scratch_dir(spark)}/catalog-{uuid4().hex}"
    counted = jobs.load_catalog(bindings.orders_catalog(spark, sf), base)
    names = spark.createDataFrame(list(counted.items()), "name string, counted bigint")
    found = None
    for name in counted:
        rows = read_collection(spark, base, name).agg(F.count("*").alias("found"))
        rows = rows.withColumn("name", F.lit(name))
        found = rows if found is None else found.unionByName(rows)
    return names.join(found, "name")


def _listed_speaker_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Customer and clerk as listed speakers with blanks and gaps, priority as presenter.

    Every third order has its id in ``_id`` only, every seventh none at all.
    """
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    number = F.col("o_orderkey")
    own = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    profiles = orders.select(
        F.when(number % 7 == 0, F.lit(None)).when(number % 3 == 0, F.lit("")).otherwise(number.cast("string"))
        .alias("video_id"),
        F.when(number % 7 != 0, number.cast("string")).alias("_id"),
        F.array(F.concat(F.lit(" \t"), own), own, F.lit(None), F.lit(" ")).alias("speakers"),
        F.when(number % 2 == 0, F.col("o_orderpriority")).alias("presenterDisplayName"),
    )
    return _flat_paths(paths.speaker_paths(profiles))


def _resolve_bare_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Lists whose entries lack the score or the reasons."""
    lists = _orders_lists(spark, sf).select(
        "_id",
        F.transform(
            "recommendations",
            lambda r, i: F.struct(
                r["video_id"].alias("video_id"),
                F.when(i % 2 == 0, r["score"]).alias("score"),
                F.when(i % 3 == 0, r["reasons"]).alias("reasons"),
            ),
        ).alias("recommendations"),
    )
    rows = lookup.get_watch_next(
        _requests(spark, sf), lists, _orders_profiles(spark, sf), 10, _buckets(spark, sf)
    )
    return rows.select(
        "talk_id", F.col("pos").cast("bigint").alias("pos"), "video_id", "score", _joined("reasons")
    )


def _search_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    index = _orders_tag_index(spark, sf)
    hits = search.search_by_tag(_orders_profiles(spark, sf), ASKED_TAG, index=index)
    return hits.withColumn("tags", _joined("tags"))


def _search_talks(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders above a price and within some years, by the users who saw them."""
    tables = bindings.orders_catalog(spark, sf)
    talks = catalog.enrich_catalog(tables.talks, tables.details)
    progress = bindings.events_progress(spark, sf)
    hits = search.search_talks(talks, progress, ASKED_WORD, 100_000, 400_000.5, 1996, 1999, 50)
    return hits.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd"))


def _search_by_speaker(spark: SparkSession, sf: str) -> DataFrame:
    return search.search_by_speaker(_orders_profiles(spark, sf), ASKED_SPEAKER)


def _get_talk(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.get_talk(_orders_profiles(spark, sf), ASKED_TALK).withColumn(
        "tags", _joined("tags")
    )


def _get_talks(spark: SparkSession, sf: str) -> DataFrame:
    found = lookup.get_talks(
        _orders_profiles(spark, sf), _requests(spark, sf), _buckets(spark, sf)
    )
    return found.withColumn("tags", _joined("tags"))


def _with_package(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """Let Python workers find the package also where the session was started elsewhere."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        environment = spark.sparkContext.environment
        paths = environment.get("PYTHONPATH", "").split(os.pathsep)
        if _HERE not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([_HERE, *filter(None, paths)])
        return query(spark, sf)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    found = core_queries()
    if llm:
        found |= {name: _with_package(query) for name, query in llm.queries().items()}
        found["pipeline"] = _with_package(corpus_pipeline.run)
    return found


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries that need nothing but the library proper."""
    return {
        "enrich_catalog": _enrich_catalog,
        "tag_lists": _tag_lists,
        "clean_talks": _clean_talks,
        "clean_copied_talks": _clean_copied_talks,
        "clean_tags": lambda spark, sf: _orders(spark, sf)[0],
        "clean_related": lambda spark, sf: _orders(spark, sf)[1],
        "talk_profiles": _talk_profiles,
        "common_tag_pairs": _common_tag_pairs,
        "related_tag_counts": _related_tag_counts,
        "candidates": _candidates,
        "scored_candidates": _scored_candidates,
        "top_recommendations": _top_recommendations,
        "watch_next": _watch_next,
        "resolve_watch_next": _resolve_watch_next,
        "get_watch_next": _get_watch_next,
        "tag_paths": _tag_paths,
        "speaker_paths": _speaker_paths,
        "topic_paths": _topic_paths,
        "topic_paths_dedup": _topic_paths_dedup,
        "build_paths": _build_paths,
        "path_summary": _path_summary,
        "learning_stats": _learning_stats,
        "learning_stats_requested": _learning_stats_requested,
        "learning_stats_of_one": _learning_stats_of_one,
        "learning_stats_odd": _learning_stats_odd,
        "search_by_tag": _search_by_tag,
        "search_by_speaker": _search_by_speaker,
        "search_talks": _search_talks,
        "load_catalog": _load_catalog,
        "listed_speaker_paths": _listed_speaker_paths,
        "resolve_bare_lists": _resolve_bare_lists,
        "get_talk": _get_talk,
        "get_talks": _get_talks,
    }


# The test tables as a catalog, in SQL.
_ORDERS = """
talks as (
    select o_orderkey::varchar as id, 'order-' || o_orderkey as slug, c_name as speakers,
           'Order ' || o_orderkey as title, 'https://example.org/o/' || o_orderkey as url
    from orders join customer on o_custkey = c_custkey),
details as (
    select o_orderkey::varchar as id, o_orderpriority as description,
           o_totalprice::varchar as duration, o_orderdate::varchar as "publishedAt"
    from orders),
raw_tags as (
    select l_orderkey::varchar as id, 'part-' || l_partkey as tag from lineitem),
raw_related as (
    select o_orderkey::varchar as id,
           (lead(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey))::varchar
               as related_id
    from orders),
tags as (
    select distinct id as video_id, tag from raw_tags where id is not null and tag is not null),
related as (
    select distinct id as source_video_id, related_id as related_video_id
    from raw_related where id is not null and related_id is not null),
clean as (
    select id as video_id, slug, speakers, title, url from talks where id is not null
    qualify row_number() over (partition by id order by slug, speakers, title, url) = 1),
tag_sets as (
    select video_id, string_agg(tag, ',' order by tag) as tags from tags group by video_id),
profiles as (
    select clean.*, coalesce(tags, '') as tags from clean left join tag_sets using (video_id))
"""

_DOCUMENTS = r"""
raw_tags as (
    select doc_id::varchar as video_id,
           unnest(list_distinct(regexp_split_to_array(lower(text), '[^\p{L}]+'))) as tag
    from documents),
topic_members as (
    select distinct video_id, tag as title from raw_tags where length(tag) >= 2),
speaker_members as (
    select distinct doc_id::varchar as video_id, source as title
    from documents where length(source) > 0)
"""

# Every pair of talks sharing a tag.
_ALL_PAIRS = """
all_pairs as (
    select x.video_id as a, y.video_id as b, count(*) as n
    from tags x join tags y using (tag) where x.video_id <> y.video_id group by 1, 2)"""

_ALL_PARTNERS = """
partners as (
    select a, b, n from all_pairs)"""

# Every pair, then the ten best partners of each talk.
_PAIRS = f"""{_ALL_PAIRS},
partners as (
    select a, b, n from all_pairs
    qualify row_number() over (partition by a order by n desc, b) <= 10)
"""

_CANDIDATES = """
linked as (
    select source_video_id as a, related_video_id as b, coalesce(n, 0) as n
    from related left join all_pairs on a = source_video_id and b = related_video_id),
pairs as (
    select a, b, max(r)::bigint as r, max(n)::bigint as n
    from (select a, b, 1 as r, n from linked union all select a, b, 0, n from partners)
    group by a, b),
scored as (
    select a, b, r, n, (r * 5 + n * 3)::double as score,
           concat_ws(',', case when r = 1 then 'related_video' end,
                     case when n > 0 then 'common_tags' end) as reasons
    from pairs)
"""

# The ranking over all candidates, the partners not cut before.
_RANKED = """
every as (
    select coalesce(p.a, source_video_id) as a, coalesce(p.b, related_video_id) as b,
           (case when source_video_id is null then 0 else 1 end) as r, coalesce(n, 0) as n
    from all_pairs p full outer join related
         on p.a = source_video_id and p.b = related_video_id),
ranked as (
    select a, b, (r * 5 + n * 3)::double as score,
           concat_ws(',', case when r = 1 then 'related_video' end,
                     case when n > 0 then 'common_tags' end) as reasons,
           row_number() over (partition by a order by r * 5 + n * 3 desc, b) as rank
    from every qualify rank <= 10)
"""

_REQUESTS = """
requests as (
    select o_orderkey::varchar as talk_id from orders
    union select 'c-' || c_custkey from customer)
"""


def _slug(prefix: str) -> str:
    return (
        f"'{prefix}_' || regexp_replace(replace(trim(regexp_replace(lower(title), '\\s+', ' ', 'g')),"
        " ' ', '_'), '[^a-z0-9_-]', '', 'g')"
    )


def _ranked_paths(kind: str, members: str, name: str) -> str:
    return f"""
{name} as (
    select row_number() over (order by count(*) desc, title) as rk, title, count(*) as n
    from {members} group by title having count(*) >= 3
    qualify rk <= 30)"""


def _path_rows(kind: str, members: str, ranked: str) -> str:
    return f"""
select {_slug(kind)} as path_id, title, '{kind}' as type, n as video_count, video_id
from {ranked} join {members} using (title)"""


# The greedy pass: one step per rank, carrying the ranks kept so far.
_KEPT = """
m as (select rk, n, video_id as v from top_topics join topic_members using (title)),
conflict as (
    select a.rk, b.rk as o from m a join m b on a.v = b.v and b.rk < a.rk
    group by a.rk, b.rk, a.n, b.n having count(*)::double / (a.n + b.n - count(*)) >= 0.8),
clashes as (
    select t.rk, coalesce(list(o) filter (o is not null), []) as cs
    from top_topics t left join conflict using (rk) group by t.rk),
step(rk, kept) as (
    select 0::bigint, []::bigint[]
    union all
    select c.rk, case when list_has_any(step.kept, c.cs) then step.kept
                      else list_append(step.kept, c.rk) end
    from step join clashes c on c.rk = step.rk + 1),
kept_topics as (
    select * from top_topics
    where rk in (select unnest(kept) from (select kept from step order by rk desc limit 1)))
"""

_SUM = "fsum({0})"
_ROUND = "cast(format('{{:.1f}}', {0}) as double)"

_STATS = f"""
progress as (
    select user_id::varchar as u, json_extract_string(props, '$.k') as talk, value,
           event_type = 'view' as watched, event_type = 'purchase' as completed
    from events where event_type in ('view', 'click', 'purchase')),
quizzes as (
    select user_id::varchar as u, value, event_type = 'signup' as completed
    from events where event_type in ('signup', 'error')),
by_talks as (
    select u, count(distinct talk) filter (watched or completed) as w,
           count(distinct talk) filter (completed) as c, {_SUM.format("value")} as seconds
    from progress group by u),
by_quizzes as (
    select u, count(*) filter (completed) as q,
           {_SUM.format("case when completed then value end")}
               / nullif(count(value) filter (completed), 0) as mean
    from quizzes group by u),
stats as (
    select coalesce(t.u, z.u) as "userId", coalesce(w, 0) as "talksWatched",
           coalesce(c, 0) as "talksCompleted",
           {_ROUND.format("coalesce(seconds, 0) / 60")} as "minutesViewed",
           coalesce(q, 0) as "quizzesCompleted",
           {_ROUND.format("coalesce(mean, 0)")} as "averageQuizScore"
    from by_talks t full outer join by_quizzes z on t.u = z.u)
"""


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL, by the direct definition, where SQL can express them."""
    return core_oracle_sql() | (llm.oracle_sql() if llm else {})


def core_oracle_sql() -> dict[str, str]:
    top_topics = _ranked_paths("topic", "topic_members", "top_topics")
    top_speakers = _ranked_paths("speaker", "speaker_members", "top_speakers")
    topic_rows = _path_rows("topic", "topic_members", "kept_topics")
    return {
        "enrich_catalog": f"""with {_ORDERS}
            select talks.*, description, duration, "publishedAt"
            from talks left join details using (id)""",
        "tag_lists": f"""with {_ORDERS}
            select id as video_id, string_agg(tag, ',' order by tag) as tags,
                   count(tag) as n_tags
            from raw_tags group by id""",
        "clean_talks": f"with {_ORDERS} select * from clean",
        "clean_tags": f"with {_ORDERS} select * from tags",
        "clean_related": f"with {_ORDERS} select * from related",
        "talk_profiles": f"with {_ORDERS} select * from profiles",
        "common_tag_pairs": f"""with {_ORDERS}, {_ALL_PAIRS}, {_ALL_PARTNERS}
            select a as source_video_id, b as candidate_video_id, n as common_tag_count
            from partners""",
        "related_tag_counts": f"""with {_ORDERS}, {_PAIRS}
            select source_video_id, related_video_id as candidate_video_id,
                   coalesce(n, 0)::bigint as common_tag_count
            from related left join all_pairs on a = source_video_id and b = related_video_id""",
        "candidates": f"""with {_ORDERS}, {_ALL_PAIRS}, {_ALL_PARTNERS}, {_CANDIDATES}
            select a as source_video_id, b as candidate_video_id, r as is_related,
                   n as common_tag_count
            from pairs""",
        "scored_candidates": f"""with {_ORDERS}, {_PAIRS}, {_CANDIDATES}
            select a as source_video_id, b as candidate_video_id, r as is_related,
                   n as common_tag_count, score, reasons
            from scored""",
        "top_recommendations": f"""with {_ORDERS}, {_PAIRS}, {_RANKED}
            select a as source_video_id, b as candidate_video_id, score, rank from ranked""",
        "watch_next": f"""with {_ORDERS}, {_PAIRS}, {_RANKED}
            select a as _id, rank - 1 as pos, b as video_id, score, reasons from ranked""",
        "resolve_watch_next": f"""with {_ORDERS}, {_PAIRS}, {_RANKED}, {_REQUESTS},
            found as (
                select a, b, score, reasons, title,
                       row_number() over (partition by a order by rank) - 1 as pos,
                       count(*) over (partition by a) as total
                from ranked join profiles on b = video_id)
            select talk_id, coalesce(total, 0) as total,
                   case when talk_id not in (select a from ranked)
                        then 'No recommendations found' end as message,
                   pos, b as video_id, score, reasons, title
            from requests left join found on a = talk_id""",
        "get_watch_next": f"""with {_ORDERS}, {_PAIRS}, {_RANKED}, {_REQUESTS}
            select talk_id, rank - 1 as pos, profiles.*, score, reasons
            from requests join ranked on a = talk_id and rank <= 5
                 join profiles on b = video_id""",
        "tag_paths": f"""with {_ORDERS}
            select tag as _id, 'Percorso: ' || tag as title, video_count, video_id,
                   clean.title as video_title
            from (select *, count(*) over (partition by tag) as video_count from tags)
                 left join clean using (video_id)
            where video_count >= 3""",
        "speaker_paths": f"""with {_ORDERS},
            members as (
                select distinct video_id, speakers as title from profiles where length(speakers) > 0),
            {_ranked_paths("speaker", "members", "top_speakers")}
            {_path_rows("speaker", "members", "top_speakers")}""",
        "topic_paths": f"""with {_DOCUMENTS}, {top_topics}
            {_path_rows("topic", "topic_members", "top_topics")}""",
        "topic_paths_dedup": f"""with recursive {_DOCUMENTS}, {top_topics}, {_KEPT}
            {topic_rows}""",
        "build_paths": f"""with recursive {_DOCUMENTS}, {top_topics}, {_KEPT}, {top_speakers}
            {topic_rows}
            union all
            {_path_rows("speaker", "speaker_members", "top_speakers")}""",
        "path_summary": f"""with recursive {_DOCUMENTS}, {top_topics}, {_KEPT}, {top_speakers}
            select s as speaker_paths, t as topic_paths, s + t as total_paths, videos_analyzed
            from (select count(*) as s from top_speakers), (select count(*) as t from kept_topics),
                 (select count(*) as videos_analyzed from documents)""",
        "learning_stats": f"with {_STATS} select * from stats",
        "clean_copied_talks": f"""with {_ORDERS},
            every as (
                select * from talks
                union all
                select id, reverse(slug), 'A ' || speakers, title, url from talks
                where id::bigint % 3 = 0)
            select id as video_id, slug, speakers, title, url from every
            qualify row_number() over (partition by id order by slug, speakers, title, url) = 1""",
        "learning_stats_of_one": f"""with {_STATS}
            select asked as "userId", coalesce("talksWatched", 0) as "talksWatched",
                   coalesce("talksCompleted", 0) as "talksCompleted",
                   coalesce("minutesViewed", 0) as "minutesViewed",
                   coalesce("quizzesCompleted", 0) as "quizzesCompleted",
                   coalesce("averageQuizScore", 0) as "averageQuizScore"
            from (select unnest(['{ASKED_USER}', 'nobody']) as asked)
                 left join stats on asked = "userId" """,
        "learning_stats_odd": f"""
            select l_suppkey::varchar as "userId", count(distinct l_partkey) as "talksWatched",
                   count(distinct l_partkey) as "talksCompleted", count(*) as "quizzesCompleted",
                   {_ROUND.format("coalesce(fsum(x), 0) / 60")} as "minutesViewed",
                   {_ROUND.format("coalesce(fsum(x) / nullif(count(x), 0), 0)")} as "averageQuizScore"
            from (select *, case l_linenumber % 5 when 0 then null when 1 then null
                                 when 2 then l_extendedprice / 7e15
                                 when 3 then l_extendedprice * 1e9
                                 else l_extendedprice / 7 end as x from lineitem)
            group by 1""",
        "learning_stats_requested": f"""with {_STATS}
            select c_custkey::varchar as "userId", coalesce("talksWatched", 0) as "talksWatched",
                   coalesce("talksCompleted", 0) as "talksCompleted",
                   coalesce("minutesViewed", 0) as "minutesViewed",
                   coalesce("quizzesCompleted", 0) as "quizzesCompleted",
                   coalesce("averageQuizScore", 0) as "averageQuizScore"
            from customer left join stats on c_custkey::varchar = "userId" """,
        "search_by_tag": f"""with {_ORDERS}
            select video_id, title, speakers, url, tags from profiles
            where list_contains(string_split(tags, ','), lower('{ASKED_TAG}'))
            order by video_id limit 5""",
        "search_by_speaker": f"""with {_ORDERS}
            select video_id, title, speakers, url from profiles
            where regexp_matches(speakers, '(?i){ASKED_SPEAKER}') order by video_id limit 5""",
        "load_catalog": f"""with {_ORDERS},
            counts as (
                select 'tedx_final_list' as name, count(*) as n from talks left join details using (id)
                union all select 'tedx_details', count(*) from details
                union all select 'tedx_tags', count(distinct id) from raw_tags
                union all select 'tedx_images', count(*) from orders
                union all select 'tedx_related_videos', count(*) from raw_related where related_id is not null)
            select name, n as counted, n as found from counts""",
        "listed_speaker_paths": f"""with
            members as (
                select distinct o_orderkey::varchar as video_id, unnest(
                    case when o_orderkey % 2 = 0 then ['c' || o_custkey, trim(o_orderpriority)]
                         else ['c' || o_custkey] end) as title
                from orders where o_orderkey % 7 <> 0),
            {_ranked_paths("speaker", "members", "top_speakers")}
            {_path_rows("speaker", "members", "top_speakers")}""",
        "resolve_bare_lists": f"""with {_ORDERS}, {_PAIRS}, {_RANKED}, {_REQUESTS}
            select talk_id, rank - 1 as pos, b as video_id,
                   case when (rank - 1) % 2 = 0 then score else 0 end as score,
                   case when (rank - 1) % 3 = 0 then reasons else '' end as reasons
            from requests join ranked on a = talk_id join profiles on b = video_id""",
        "search_talks": f"""with {_ORDERS},
            seen as (
                select json_extract_string(props, '$.k') as id, count(distinct user_id) as viewers
                from events where event_type in ('view', 'click', 'purchase') group by 1)
            select talks.id, title, speakers, url, duration::double as duration_s,
                   strftime("publishedAt"::timestamp, '%Y-%m-%d') as published_at,
                   coalesce(viewers, 0) as viewers
            from talks join details using (id) left join seen using (id)
            where (contains(lower(title), '{ASKED_WORD}') or contains(lower(description), '{ASKED_WORD}'))
              and duration::double between 100000 and 400000.5
              and year("publishedAt"::timestamp) between 1996 and 1999
            order by viewers desc, id limit 50""",
        "get_talk": f"with {_ORDERS} select * from profiles where video_id = '{ASKED_TALK}'",
        "get_talks": f"""with {_ORDERS}, {_REQUESTS}
            select profiles.* from profiles where video_id in (select talk_id from requests)""",
    }

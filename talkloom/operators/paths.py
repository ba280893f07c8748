"""Learning paths: talks grouped by tag, by speaker and by topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions import path_id, strip
from talkloom.sources.scratch import keep

# Smallest path, paths kept per kind, shortest topic, and the
# overlap from which a smaller path repeats a larger one.
MIN_TALKS = 3
MAX_PATHS = 30
MIN_TOPIC_LENGTH = 2
NEAR_DUPLICATE = 0.80
TAG_PATH_TITLE = "Percorso: "


def tag_path_headers(tags: DataFrame, min_talks: int = MIN_TALKS) -> DataFrame:
    """One row a path, for tags with at least ``min_talks`` talks: _id, title, video_count."""
    return (
        tags.groupBy(F.col("tag").alias("_id"))
        .agg(F.count("*").alias("video_count"))
        .where(F.col("video_count") >= min_talks)
        .select("_id", F.concat(F.lit(TAG_PATH_TITLE), "_id").alias("title"), "video_count")
    )


def tag_paths(talks: DataFrame, tags: DataFrame, min_talks: int = MIN_TALKS) -> DataFrame:
    """Tag paths by member: the header's columns, video_id and video_title.

    ``talks`` and ``tags`` are cleaned. A path grows with the catalog, so its members
    are rows, however many they are. A tagged id missing from the catalog is a member
    without a title.
    """
    # Each join ends in a shuffle on another key, so a popular tag can be split.
    named = talks.select("video_id", F.col("title").alias("video_title"))
    headers = tag_path_headers(tags, min_talks)
    return (
        tags.withColumnRenamed("tag", "_id")
        .join(headers, "_id")
        .join(named, "video_id", "left")
        .select("_id", "title", "video_count", "video_id", "video_title")
    )


def talk_ids(profiles: DataFrame) -> Column:
    """The talk id as text: ``video_id``, or ``_id`` where that is empty."""
    names = [c for c in ("video_id", "_id") if c in profiles.columns]
    return F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in names])


def speaker_members(profiles: DataFrame, unique: bool = False) -> DataFrame:
    """Distinct (title, video_id): every speaker with every talk they gave.

    ``unique`` states that no two profiles share an id, as those of
    ``talk_profiles``; then no shuffle is needed to count a talk once. A text is one speaker and never split. ``presenterDisplayName`` adds a
    speaker where the column exists.
    """
    names = []
    for column in ("speakers", "presenterDisplayName"):
        if column in profiles.columns:
            listed = profiles.schema[column].dataType.typeName() == "array"
            names.append(F.col(column) if listed else F.array(F.col(column).cast("string")))
    everyone = F.flatten(F.array(*[F.coalesce(n, F.array()) for n in names]))
    return _members(profiles, everyone, F.length("title") > 0, unique)


def topic_sets(
    profiles: DataFrame, unique: bool = False, min_length: int = MIN_TOPIC_LENGTH
) -> DataFrame:
    """Each talk's distinct topics: video_id and titles, every tag long enough, case kept.

    ``unique`` is as for :func:`speaker_members`.
    """
    titles = F.filter(
        F.array_distinct(F.transform("tags", strip)),
        lambda t: t.isNotNull() & (F.length(t) >= min_length),
    )
    sets = profiles.select(talk_ids(profiles).alias("video_id"), titles.alias("titles"))
    sets = sets.where(F.col("video_id").isNotNull())
    if unique:
        return sets
    each = F.array_distinct(F.flatten(F.collect_list("titles")))
    return sets.groupBy("video_id").agg(each.alias("titles"))


def topic_members(
    profiles: DataFrame, unique: bool = False, min_length: int = MIN_TOPIC_LENGTH
) -> DataFrame:
    """Distinct (title, video_id): every tag long enough with its talks, case kept."""
    sets = topic_sets(profiles, unique, min_length)
    return sets.select("video_id", F.explode("titles").alias("title"))


def _members(profiles: DataFrame, names: Column, wanted: Column, unique: bool) -> DataFrame:
    stripped = F.array_distinct(F.transform(names, strip))
    members = profiles.select(
        talk_ids(profiles).alias("video_id"), F.explode(stripped).alias("title")
    ).where(F.col("video_id").isNotNull() & F.col("title").isNotNull() & wanted)
    return members if unique else members.distinct()


def rank_paths(
    members: DataFrame, kind: str, min_talks: int = MIN_TALKS, max_paths: int = MAX_PATHS
) -> DataFrame:
    """The ``max_paths`` largest groups: rank, path_id, title, type, video_count.

    Ties go to the smaller title. At most ``max_paths`` rows, whatever the data.
    """
    largest = (
        members.groupBy("title")
        .agg(F.count("*").alias("video_count"))
        .where(F.col("video_count") >= min_talks)
        .orderBy(F.desc("video_count"), F.asc("title"))
        .limit(max_paths)
    )
    # The window sorts the few rows that are left.
    rank = F.row_number().over(Window.orderBy(F.desc("video_count"), F.asc("title")))
    return largest.select(
        rank.alias("rank"),
        path_id(kind, F.col("title")).alias("path_id"),
        "title",
        F.lit(kind).alias("type"),
        "video_count",
    )


def path_members(ranked: DataFrame, members: DataFrame) -> DataFrame:
    """Ranked paths by member: the columns of ``ranked`` and video_id, a row a talk."""
    # ranked holds at most max_paths rows, so the broadcast cannot grow.
    return members.join(F.broadcast(ranked), "title").select(
        "rank", "path_id", "title", "type", "video_count", "video_id"
    )


def speaker_paths(
    profiles: DataFrame,
    unique: bool = False,
    min_talks: int = MIN_TALKS,
    max_paths: int = MAX_PATHS,
) -> DataFrame:
    """The largest speaker paths."""
    members = speaker_members(profiles, unique)
    return path_members(rank_paths(members, "speaker", min_talks, max_paths), members)


def topic_paths(
    profiles: DataFrame,
    unique: bool = False,
    min_talks: int = MIN_TALKS,
    max_paths: int = MAX_PATHS,
) -> DataFrame:
    """The largest topic paths, near-duplicates included."""
    members = topic_members(profiles, unique)
    return path_members(rank_paths(members, "topic", min_talks, max_paths), members)


def ranked_titles(ranked: DataFrame, sets: DataFrame) -> DataFrame:
    """``sets`` with the titles of ranked paths only; talks that hold none are left out."""
    # one row with at most max_paths titles
    top = ranked.agg(F.collect_list("title").alias("top"))
    held = F.array_intersect("titles", "top").alias("titles")
    return sets.join(F.broadcast(top)).select("video_id", held).where(F.size("titles") > 0)


def drop_near_duplicates(
    ranked: DataFrame, sets: DataFrame, threshold: float = NEAR_DUPLICATE
) -> DataFrame:
    """Ranked paths without those that repeat a kept path of better rank.

    In rank order a path stays unless its Jaccard overlap with some path already
    kept reaches ``threshold``. ``sets`` has video_id and titles, a row a talk. A talk's own
    titles give its mask, the few ranked paths it is in; equal masks are counted
    before anything is shuffled, pairs come from the different masks, and the pass over the
    at most ``max_paths`` ranks handles ranks only, never talk ids.
    """
    # one row with a map of at most max_paths titles
    named = ranked.agg(
        F.map_from_entries(
            F.collect_list(F.struct("title", F.struct("rank", "video_count")))
        ).alias("places")
    ).select(F.lit(1).alias("one"), "places")
    # a map is searched key by key, so only the talk's ranked titles are looked up
    held = F.array_intersect("titles", F.map_keys("places"))
    place = F.transform(held, lambda t: F.element_at("places", t))
    masks = (
        sets.withColumn("one", F.lit(1))
        .join(F.broadcast(named), "one")
        .select(F.sort_array(place).alias("paths"))
        .where(F.size("paths") > 1)
        .groupBy("paths")
        .agg(F.count("*").alias("talks"))
    )
    pair = F.struct(
        F.col("b.rank").alias("rank"),
        F.col("a.rank").alias("other"),
        F.col("b.video_count").alias("size"),
        F.col("a.video_count").alias("other_size"),
    )
    common = (
        masks.select("talks", "paths", F.posexplode("paths").alias("at", "a"))
        .select("talks", "a", F.explode(F.slice("paths", F.col("at") + 2, F.size("paths"))).alias("b"))
        .select("talks", pair.alias("pair"))
        .groupBy("pair.rank", "pair.other", "pair.size", "pair.other_size")
        .agg(F.sum("talks").alias("common"))
    )
    union = F.col("size") + F.col("other_size") - F.col("common")
    clashes = (
        common.where(F.col("common") / union >= threshold)
        .groupBy("rank")
        .agg(F.collect_list("other").alias("others"))
    )
    steps = ranked.select("rank").join(clashes, "rank", "left").agg(
        F.sort_array(
            F.collect_list(
                F.struct("rank", F.coalesce("others", F.array().cast("array<int>")).alias("others"))
            )
        ).alias("steps")
    )
    kept = F.aggregate(
        "steps",
        F.array().cast("array<int>"),
        lambda kept, step: F.when(F.arrays_overlap(kept, step["others"]), kept).otherwise(
            F.array_append(kept, step["rank"])
        ),
    )
    return ranked.join(F.broadcast(steps.select(F.explode(kept).alias("rank"))), "rank")


def distinct_topic_paths(
    profiles: DataFrame,
    unique: bool = False,
    min_talks: int = MIN_TALKS,
    max_paths: int = MAX_PATHS,
    threshold: float = NEAR_DUPLICATE,
) -> DataFrame:
    """The largest topic paths without near-duplicates; the cut comes first."""
    sets = topic_sets(profiles, unique)
    members = sets.select("video_id", F.explode("titles").alias("title"))
    # the few ranked rows are read three times and counted once
    ranked = keep(rank_paths(members, "topic", min_talks, max_paths), "ranked-topics")
    # what each talk holds of them is found once, in one pass over all titles
    held = keep(ranked_titles(ranked, sets), "ranked-titles")
    left = keep(drop_near_duplicates(ranked, held, threshold), "distinct-topics")
    return path_members(left, held.select("video_id", F.explode("titles").alias("title")))


def build_paths(
    profiles: DataFrame,
    unique: bool = False,
    min_talks: int = MIN_TALKS,
    max_paths: int = MAX_PATHS,
    threshold: float = NEAR_DUPLICATE,
) -> DataFrame:
    """Speaker paths and distinct topic paths in one table."""
    speakers = speaker_paths(profiles, unique, min_talks, max_paths)
    topics = distinct_topic_paths(profiles, unique, min_talks, max_paths, threshold)
    return speakers.unionByName(topics).drop("rank")


def path_summary(paths: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row: speaker, topic and all paths, and the talks analysed."""
    no_type = F.lit(None).cast("string").alias("type")
    analysed = profiles.agg(F.count("*").alias("talks")).select(no_type, "talks")
    return (
        paths.select("type", "title")
        .distinct()
        .select("type", F.lit(0).cast("bigint").alias("talks"))
        .unionByName(analysed)
        .agg(
            F.count_if(F.col("type") == "speaker").alias("speaker_paths"),
            F.count_if(F.col("type") == "topic").alias("topic_paths"),
            F.count("type").alias("total_paths"),
            F.sum("talks").alias("videos_analyzed"),
        )
    )

"""Answering lookups: recommendations of requested talks, and single talks.

Stored lists and profiles may be bucketed by talk id (``write_bucketed``). Requests and
listed ids are then brought to the buckets, and the stored rows stay where they are; with
``buckets``, their number, also where the session shuffles to more partitions than that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 5
NOTHING_FOUND = "No recommendations found"


def _requested(requests: DataFrame, buckets: int | None = None) -> DataFrame:
    """The asked talk ids as text; empty ones are no request."""
    ids = requests.select(F.col("talk_id").cast("string")).where(F.length("talk_id") > 0)
    return (ids.repartition(buckets, "talk_id") if buckets else ids).distinct()


def _listed(requests: DataFrame, watch_next: DataFrame, buckets: int | None) -> DataFrame:
    lists = watch_next.select(F.col("_id").alias("talk_id"), "recommendations")
    return _requested(requests, buckets).join(lists.hint("merge"), "talk_id", "left")


def resolve_watch_next(
    requests: DataFrame, watch_next: DataFrame, profiles: DataFrame, buckets: int | None = None
) -> DataFrame:
    """One answer per requested talk: total, recommendations in order, message.

    Each recommendation carries its talk's profile, as many columns as ``profiles`` has;
    those whose talk is unknown are left out. The message tells a talk without a list from
    an empty answer.
    """
    listed = _listed(requests, watch_next, buckets)
    rows = listed.select("talk_id", F.posexplode("recommendations").alias("pos", "rec"))
    video = F.struct(*[F.col(c) for c in profiles.columns])
    talks = profiles.select(F.col("video_id").alias("rec_id"), video.alias("video"))
    entry = F.struct(
        "pos",
        F.col("rec.video_id").alias("video_id"),
        F.coalesce("rec.score", F.lit(0.0)).alias("score"),
        F.coalesce("rec.reasons", F.array().cast("array<string>")).alias("reasons"),
        "video",
    )
    entries = rows.join(talks.hint("merge"), F.col("rec.video_id") == F.col("rec_id")).select(
        "talk_id", entry.alias("entry")
    )
    # A list is short, so the answer of a talk is bounded.
    answers = (
        (entries.repartition(buckets, "talk_id") if buckets else entries)
        .groupBy("talk_id")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    )
    found = F.coalesce(
        F.transform(
            "entries",
            lambda e: F.struct(e["video_id"], e["score"], e["reasons"], e["video"]),
        ),
        F.array(),
    )
    message = F.when(F.col("recommendations").isNull(), F.lit(NOTHING_FOUND))
    return (
        listed.select("talk_id", message.alias("message"))
        .join(answers, "talk_id", "left")
        .select(
            "talk_id",
            F.size(found).cast("bigint").alias("total"),
            found.alias("recommendations"),
            "message",
        )
    )


def get_watch_next(
    requests: DataFrame,
    watch_next: DataFrame,
    profiles: DataFrame,
    limit: int = DEFAULT_LIMIT,
    buckets: int | None = None,
) -> DataFrame:
    """The first ``limit`` recommendations of each requested talk, flat.

    The cut comes before unknown talks are left out, so fewer may remain.
    """
    first = F.slice("recommendations", 1, limit)
    listed = _listed(requests, watch_next, buckets)
    rows = listed.select("talk_id", F.posexplode(first).alias("pos", "rec"))
    talks = profiles.hint("merge")
    return rows.join(talks, F.col("rec.video_id") == F.col("video_id")).select(
        "talk_id",
        "pos",
        *profiles.columns,
        F.coalesce("rec.score", F.lit(0.0)).alias("score"),
        F.coalesce("rec.reasons", F.array().cast("array<string>")).alias("reasons"),
    )


def get_talk(profiles: DataFrame, video_id: str) -> DataFrame:
    """The profile of one talk, or no row; the filter reaches the scan."""
    return profiles.where(F.col("video_id") == str(video_id))


def get_talks(profiles: DataFrame, requests: DataFrame, buckets: int | None = None) -> DataFrame:
    """The profiles of all requested talks."""
    asked = _requested(requests, buckets).withColumnRenamed("talk_id", "video_id")
    return profiles.join(asked, "video_id", "left_semi")

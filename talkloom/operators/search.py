"""Searching talks by tag, by speaker, and by words, length and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.functions import lenient_double

DEFAULT_LIMIT = 5
COLUMNS = ("video_id", "title", "speakers", "url")


def tag_index(profiles: DataFrame) -> DataFrame:
    """(tag, video_id) of every tag of every talk, to be stored by tag."""
    return profiles.select(F.explode(F.array_distinct("tags")).alias("tag"), "video_id")


def search_by_tag(
    profiles: DataFrame, tag: str, limit: int = DEFAULT_LIMIT, index: DataFrame | None = None
) -> DataFrame:
    """Talks that carry the tag, in id order. The argument is lower-cased, stored tags are not.

    With a stored ``index`` (:func:`tag_index`) only the rows of the tag and then the talks
    of the ``limit`` smallest ids are read: both filters reach the scans. The ids, no more
    than ``limit``, are looked up when this is called.
    """
    wanted = F.lower(F.lit(tag))
    if index is None:
        hits = profiles.where(F.array_contains("tags", wanted))
    else:
        ids = index.where(F.col("tag") == wanted).select("video_id").orderBy("video_id").limit(limit)
        hits = profiles.where(F.col("video_id").isin([row["video_id"] for row in ids.collect()]))
    return hits.select(*COLUMNS, "tags").orderBy("video_id").limit(limit)


def search_by_speaker(profiles: DataFrame, pattern: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Talks whose speakers match the regular expression anywhere, in any case, in id order."""
    hits = profiles.where(F.col("speakers").rlike(f"(?iu){pattern}"))
    return hits.select(*COLUMNS).orderBy("video_id").limit(limit)


def typed_talks(talks: DataFrame) -> DataFrame:
    """Enriched talks with ``duration_s`` (seconds) and ``published_at``, null where unreadable."""
    seconds = lenient_double(F.col("duration"), talks.schema["duration"].dataType)
    published = F.col("publishedAt").cast("string").try_cast("timestamp")
    return talks.withColumns({"duration_s": seconds, "published_at": published})


def search_talks(
    talks: DataFrame,
    progress: DataFrame,
    keyword: str | None = None,
    shortest: float | None = None,
    longest: float | None = None,
    first_year: int | None = None,
    last_year: int | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Talks by a keyword, a range of seconds and a range of years, most viewed first.

    ``talks`` has the columns of ``enrich_catalog``, ``progress`` userId and talkId. The keyword
    is contained in title or description, in any case; ranges include their ends, and a talk
    whose duration or date is missing or unreadable is in no range. Talks are ranked by
    distinct viewers, then by id. Gives id, title, speakers, url, duration_s,
    published_at and viewers. A talk with several details counts once, with the
    smallest duration, then date, of those that fit.

    Viewers are counted per talk before they meet the talks that fit, and only the best
    ``limit`` leave a task.
    """
    found = typed_talks(talks).where(F.col("id").isNotNull())
    if keyword is not None:
        word = F.lower(F.lit(keyword))
        inside = [F.contains(F.lower(F.col(c)), word) for c in ("title", "description")]
        found = found.where(F.coalesce(inside[0], F.lit(False)) | F.coalesce(inside[1], F.lit(False)))
    for bound, column, holds in (
        (shortest, F.col("duration_s"), "__ge__"),
        (longest, F.col("duration_s"), "__le__"),
        (first_year, F.year("published_at"), "__ge__"),
        (last_year, F.year("published_at"), "__le__"),
    ):
        if bound is not None:
            found = found.where(getattr(column, holds)(F.lit(bound)))
    rest = F.struct("duration_s", "published_at", "title", "speakers", "url")
    found = found.groupBy("id").agg(F.min(rest).alias("rest")).select("id", "rest.*")
    seen = progress.where(F.col("userId").isNotNull()).select(F.col("talkId").alias("id"), "userId")
    viewers = seen.distinct().groupBy("id").agg(F.count("*").alias("viewers"))
    ranked = found.join(viewers, "id", "left").withColumn("viewers", F.coalesce("viewers", F.lit(0)))
    columns = ["id", "title", "speakers", "url", "duration_s", "published_at", "viewers"]
    return ranked.select(columns).orderBy(F.desc("viewers"), "id").limit(limit)

"""Cleaning the input tables and joining them into talk profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_catalog(talks: DataFrame, details: DataFrame) -> DataFrame:
    """Talks with description, duration and publishedAt; talks without details stay.

    Details are not deduplicated: a talk with two detail rows gives two rows.
    """
    facts = rename_details(details)
    return talks.join(facts, talks["id"] == facts["id_ref"], "left").drop("id_ref")


def rename_details(details: DataFrame) -> DataFrame:
    """The details collection: its key is called ``id_ref``."""
    return details.select(F.col("id").alias("id_ref"), "description", "duration", "publishedAt")


def tag_lists(tags: DataFrame) -> DataFrame:
    """Tags per talk as written, duplicates kept, null tags skipped, sorted.

    One row a talk, as in ``talk_profiles``: a talk's own tags are one record.
    """
    return tags.groupBy(F.col("id").alias("_id")).agg(
        F.sort_array(F.collect_list("tag")).alias("tags")
    )


def clean_talks(talks: DataFrame) -> DataFrame:
    """One row per talk id, the smallest where copies differ; null ids dropped."""
    rest = F.struct("slug", "speakers", "title", "url")
    return (
        talks.where(F.col("id").isNotNull())
        .groupBy(F.col("id").alias("video_id"))
        .agg(F.min(rest).alias("rest"))
        .select("video_id", "rest.*")
    )


def clean_tags(tags: DataFrame) -> DataFrame:
    """Distinct (talk, tag) pairs without nulls, dealt by talk.

    A talk has few tags, and what is counted by talk next needs no other shuffle.
    """
    return _present_pairs(tags, id="video_id", tag="tag").repartition("video_id").distinct()


def clean_related(related: DataFrame) -> DataFrame:
    """Distinct (source, related) links without nulls; self-links stay."""
    return _present_pairs(related, id="source_video_id", related_id="related_video_id").distinct()


def _present_pairs(df: DataFrame, **names: str) -> DataFrame:
    columns = [F.col(old).alias(new) for old, new in names.items()]
    present = [F.col(new).isNotNull() for new in names.values()]
    return df.select(*columns).where(present[0] & present[1])


def talk_profiles(talks: DataFrame, tags: DataFrame) -> DataFrame:
    """One row per talk with its distinct tags, sorted; no tags gives an empty array.

    Both sides are grouped by the talk id, so merging them adds no shuffle, and
    the tag arrays are never broadcast on a size guessed too low.
    """
    tag_sets = (
        tags.where(F.col("id").isNotNull() & F.col("tag").isNotNull())
        .groupBy(F.col("id").alias("video_id"))
        .agg(F.sort_array(F.collect_set("tag")).alias("tags"))
    )
    no_tags = F.array().cast("array<string>")
    return (
        clean_talks(talks)
        .join(tag_sets.hint("merge"), "video_id", "left")
        .withColumn("tags", F.coalesce("tags", no_tags))
    )

"""The batch jobs: input tables to written collections.

A job writes a collection once and reads it back where it is needed again, so
nothing is computed twice and a lost executor costs its own tasks only. Row
counts come from the write itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from talkloom.operators import catalog, paths, recommend, search
from talkloom.sources.files import Catalog, read_collection, write_collection


#: what collections are looked up by
KEYS = {
    "tedx_final_list": "id",
    "tedx_details": "id_ref",
    "tedx_tags": "_id",
    "tedx_videos": "video_id",
    "tedx_video_tags": "tag",
    "tedx_watch_next": "_id",
    "tag_path_members": "_id",
    "tedx_user_progress": "userId",
    "tedx_quiz_results": "userId",
}


def _write_counted(df: DataFrame, base: str, name: str) -> int:
    seen = Observation()
    write_collection(df, base, name, key=KEYS.get(name), seen=seen)
    return seen.get["rows"]


def load_records(progress: DataFrame, quizzes: DataFrame, base: str) -> dict[str, int]:
    """Write progress and quiz records, clustered by user."""
    frames = {"tedx_user_progress": progress, "tedx_quiz_results": quizzes}
    return {name: _write_counted(df, base, name) for name, df in frames.items()}


def load_catalog(tables: Catalog, base: str) -> dict[str, int]:
    """Write the five catalog collections; gives the rows of each."""
    frames = {
        "tedx_final_list": catalog.enrich_catalog(tables.talks, tables.details),
        "tedx_details": catalog.rename_details(tables.details),
        "tedx_tags": catalog.tag_lists(tables.tags),
        "tedx_images": tables.images,
        "tedx_related_videos": tables.related,
    }
    return {name: _write_counted(df, base, name) for name, df in frames.items()}


def generate_recommendations(tables: Catalog, base: str) -> dict[str, int]:
    """Write talk profiles, the index of their tags and recommendation lists."""
    spark = tables.talks.sparkSession
    profiles = catalog.talk_profiles(tables.talks, tables.tags)
    written = {"tedx_videos": _write_counted(profiles, base, "tedx_videos")}
    frames = {
        "tedx_video_tags": search.tag_index(read_collection(spark, base, "tedx_videos")),
        "tedx_watch_next": recommend.watch_next(
            catalog.clean_tags(tables.tags), catalog.clean_related(tables.related)
        ),
    }
    return written | {name: _write_counted(df, base, name) for name, df in frames.items()}


def create_tag_paths(tables: Catalog, base: str) -> dict[str, int]:
    """Write the tag paths, a row each, and their members."""
    tags = catalog.clean_tags(tables.tags)
    frames = {
        "tag_paths": paths.tag_path_headers(tags),
        "tag_path_members": paths.tag_paths(catalog.clean_talks(tables.talks), tags),
    }
    return {name: _write_counted(df, base, name) for name, df in frames.items()}


def refresh_paths(spark: SparkSession, base: str) -> DataFrame:
    """Rebuild the paths collection from the written profiles; gives the summary.

    Without any profile, and when the write fails, the old paths stay and the job fails.
    """
    profiles = read_collection(spark, base, "tedx_videos")
    if profiles.isEmpty():
        raise ValueError("no talks found, paths left as they are")
    write_collection(paths.build_paths(profiles, unique=True), base, "paths")
    return paths.path_summary(read_collection(spark, base, "paths"), profiles)

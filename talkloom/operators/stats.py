"""Learning statistics per user from progress and quiz records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions import lenient_double, round_1
from talkloom.functions.sums import is_special, limb_sums, total, with_limbs


def _summed(rows: DataFrame, number: str, *counts: Column) -> DataFrame:
    """Per user and place the limb sums of ``number``, its special values and ``counts``."""
    limbs = F.struct("place", "high", "middle", "low")
    odd = F.when(is_special(F.col(number)), F.col(number))
    summed = with_limbs(rows, number).groupBy("userId", "place")
    summed = summed.agg(*limb_sums(), F.sum(odd).alias("odd"), *counts)
    return summed.withColumn("limbs", F.when(F.col("place").isNotNull(), limbs)).drop(
        "place", "high", "middle", "low"
    )


def _total(limbs: str, odd: str) -> Column:
    """The exact sum, or what NaN and infinities make of it."""
    return F.coalesce(F.col(odd), total(F.col(limbs)))


def learning_stats(
    progress: DataFrame,
    quizzes: DataFrame,
    users: DataFrame | None = None,
    user_id: str | None = None,
) -> DataFrame:
    """Talks watched and completed, minutes, quizzes completed and mean score.

    Seconds count on every progress row; talks count once per user, and a talk
    completed is also watched. Without ``users`` the result covers every user
    with a record; with ``users`` (a userId column) exactly those, zeros where
    there is no record. ``user_id`` asks for one user; the filter reaches the scan.

    Sums are of the exact values of the doubles, rounded once, so they depend neither on
    the order of rows nor on partitions. Talks are first counted per user and talk, numbers
    per user and power of two, so a very active user spreads over many tasks, and sums
    start before their shuffle.
    """
    if user_id is not None:
        progress = progress.where(F.col("userId") == user_id)
        quizzes = quizzes.where(F.col("userId") == user_id)
        users = progress.sparkSession.range(1).select(F.lit(user_id).alias("userId"))
    elif users is not None:
        users = users.select(F.col("userId").cast("string")).dropna().distinct()
        progress = progress.join(users, "userId", "left_semi")
        quizzes = quizzes.join(users, "userId", "left_semi")

    seconds = lenient_double(F.col("progressSeconds"), progress.schema["progressSeconds"].dataType)
    completed = F.coalesce("completed", F.lit(False))
    watched = F.coalesce("watched", F.lit(False)) | completed
    progress = progress.where(F.col("userId").isNotNull())
    talk_rows = (
        progress.where(F.col("talkId").isNotNull())
        .select("userId", "talkId", watched.alias("watched"), completed.alias("completed"))
        .groupBy("userId", "talkId")
        .agg(F.max("watched").alias("watched"), F.max("completed").alias("completed"))
        .drop("talkId")
    )
    second_rows = _summed(progress.select("userId", seconds.alias("seconds")), "seconds")
    second_rows = second_rows.withColumnsRenamed({"limbs": "second_limbs", "odd": "odd_seconds"})
    points = lenient_double(F.col("score"), quizzes.schema["score"].dataType)
    done = F.coalesce(F.col("completed"), F.lit(False))
    quiz_rows = quizzes.where(F.col("userId").isNotNull() & done).select("userId", points.alias("points"))
    counts = F.count("*").alias("quizzes"), F.count("points").alias("scores")
    point_rows = _summed(quiz_rows, "points", *counts)
    point_rows = point_rows.withColumnsRenamed({"limbs": "point_limbs", "odd": "odd_points"})
    # users without anything completed have a row as well
    known = quizzes.where(F.col("userId").isNotNull()).select("userId").distinct()
    rows = talk_rows.unionByName(second_rows, allowMissingColumns=True)
    rows = rows.unionByName(point_rows, allowMissingColumns=True)
    rows = rows.unionByName(known if users is None else users, allowMissingColumns=True)
    sums = rows.groupBy("userId").agg(
        F.count_if("watched").alias("talksWatched"),
        F.count_if("completed").alias("talksCompleted"),
        F.collect_list("second_limbs").alias("second_limbs"),
        F.sum("odd_seconds").alias("odd_seconds"),
        F.coalesce(F.sum("quizzes"), F.lit(0)).alias("quizzesCompleted"),
        F.collect_list("point_limbs").alias("point_limbs"),
        F.sum("odd_points").alias("odd_points"),
        F.sum("scores").alias("scores"),
    )
    sums = sums.withColumns(
        {"seconds": _total("second_limbs", "odd_seconds"), "points": _total("point_limbs", "odd_points")}
    )
    mean = F.when(F.col("scores") > 0, round_1(F.col("points") / F.col("scores"))).otherwise(0.0)
    return sums.select(
        "userId",
        "talksWatched",
        "talksCompleted",
        round_1(F.col("seconds") / 60).alias("minutesViewed"),
        "quizzesCompleted",
        mean.alias("averageQuizScore"),
    )

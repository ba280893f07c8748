"""Learning statistics on hand-made records."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions import lenient_double, round_1
from talkloom.functions.sums import limb_sums, total, with_limbs
from talkloom.operators.stats import learning_stats

PROGRESS = "userId string, talkId string, progressSeconds string, watched boolean, completed boolean"
QUIZZES = "userId string, quizId string, score string, completed boolean"


def _frames(spark):
    progress = [
        ("u1", "t1", "90", True, False),
        ("u1", "t1", "30", False, True),
        ("u1", "t2", None, True, None),
        ("u1", None, "60", True, True),
        ("u1", "t3", "abc", False, False),
        (None, "t3", "50", True, True),
    ]
    quizzes = [
        ("u1", "q1", "80", True),
        ("u1", "q1", "90", True),
        ("u1", "q2", None, True),
        ("u1", "q3", "100", None),
        ("u2", "q1", "70", False),
    ]
    return spark.createDataFrame(progress, PROGRESS), spark.createDataFrame(quizzes, QUIZZES)


def test_all_users(spark):
    rows = learning_stats(*_frames(spark)).orderBy("userId").collect()
    assert [tuple(r) for r in rows] == [("u1", 2, 1, 3.0, 3, 85.0), ("u2", 0, 0, 0.0, 0, 0.0)]


def test_requested_users(spark):
    users = spark.createDataFrame([("u1",), ("u3",), ("u3",)], "userId string")
    rows = learning_stats(*_frames(spark), users).orderBy("userId").collect()
    assert [tuple(r) for r in rows] == [("u1", 2, 1, 3.0, 3, 85.0), ("u3", 0, 0, 0.0, 0, 0.0)]


def test_one_user(spark):
    frames = _frames(spark)
    assert [tuple(r) for r in learning_stats(*frames, user_id="u1").collect()] == [
        ("u1", 2, 1, 3.0, 3, 85.0)
    ]
    assert [tuple(r) for r in learning_stats(*frames, user_id="u9").collect()] == [
        ("u9", 0, 0, 0.0, 0, 0.0)
    ]


def test_one_user_is_filtered_in_the_scan(spark, tmp_path):
    for name, df in zip(("p", "q"), _frames(spark)):
        df.write.parquet(f"{tmp_path}/{name}")
    tables = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("p", "q")]
    plan = learning_stats(*tables, user_id="u1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(userId,u1)") == plan.count("FileScan") > 0


def _summed(spark, groups, partitions=3):
    rows = [(i, x) for i, xs in enumerate(groups) for x in xs]
    df = spark.createDataFrame(rows, "g int, x double").repartition(partitions)
    sums = with_limbs(df, "x").groupBy("g", "place").agg(*limb_sums())
    parts = F.collect_list(F.struct("place", "high", "middle", "low")).alias("parts")
    totals = sums.groupBy("g").agg(parts).select("g", total(F.col("parts")).alias("t"))
    return {r["g"]: r["t"] for r in totals.collect()}


def test_sums_are_exact_and_rounded_once(spark):
    rnd = random.Random(9)
    groups = [[rnd.uniform(-1, 1) * 10.0 ** rnd.randrange(-12, 13) for _ in range(40)] for _ in range(40)]
    groups += [[math.ldexp(rnd.uniform(-1, 1), rnd.randrange(-1074, 1000)) for _ in range(30)] for _ in range(40)]
    groups += [
        [0.1] * 10, [1e16, 1.0, -1e16], [1e300, 1.0, -1e300, 1e-300], [5e-324] * 3, [5e-324, -5e-324],
        [2.0**53, 1.0, 2.0**-60], [2.0**53, 1.0], [2.0**53, 1.0, -(2.0**-60)], [-0.0, 0.0], [0.0],
        [2.0**k for k in range(-1074, 1000, 7)], [-(2.0**32), 2.0**32 - 1, 1.0], [-1e-320, 1.7e308],
        [2.0**1023, 2.0**1023 * (1 - 2.0**-53), -(2.0**1023)], [1e21, 2e21],
    ]
    got = _summed(spark, groups)
    for i, group in enumerate(groups):
        assert got[i] == float(sum(map(Fraction, group))), group


def test_same_sums_under_any_partitions(spark):
    rnd = random.Random(10)
    groups = [[rnd.uniform(0, 100) for _ in range(300)] for _ in range(5)]
    assert _summed(spark, groups, 1) == _summed(spark, groups, 8) == _summed(spark, groups, 64)


def test_mean_of_the_exact_values(spark):
    """Thirteen scores whose decimal digits sum to 961.35 and whose values do not."""
    scores = [96.1, 57.35, 83.07, 44.28, 90.9, 73.15, 61.6, 88.88, 52.41, 77.7, 69.99, 80.02, 85.9]
    quizzes = spark.createDataFrame([("a", "q", repr(s), True) for s in scores], QUIZZES)
    none = spark.createDataFrame([], PROGRESS)
    assert learning_stats(none, quizzes).first()["averageQuizScore"] == round(math.fsum(scores) / 13, 1)
    huge = spark.createDataFrame([("a", "q", "1e21", True), ("a", "q", "0.7499999999999999", True)], QUIZZES)
    assert learning_stats(none, huge).first()["averageQuizScore"] == 5e20
    one = spark.createDataFrame([("a", "q", "0.7499999999999999", True)], QUIZZES)
    assert learning_stats(none, one).first()["averageQuizScore"] == 0.7


def test_odd_numbers(spark):
    progress = spark.createDataFrame(
        [("a", "t", "9", True, None), ("b", "t", "inf", None, None), ("b", "t", "5", None, None),
         ("c", "t", "1e12", None, None), ("c", "t", "60", None, None), ("d", "t", "nan", None, None)],
        PROGRESS,
    )
    rows = learning_stats(progress, spark.createDataFrame([], QUIZZES)).collect()
    minutes = {r["userId"]: r["minutesViewed"] for r in rows}
    assert minutes["a"] == round(9 / 60, 1) == 0.1
    assert minutes["b"] == math.inf
    assert minutes["c"] == round((1e12 + 60) / 60, 1)
    assert math.isnan(minutes["d"])


def test_lenient_double_reads_what_python_reads(spark):
    texts = ["1", " 2.5\t", "-.5", "5.", "1e3", "1_000", "inf", "-Infinity", "NaN", "3d", "3f",
             "0x10", "", " ", "abc", "1__0", "_1", "1e", ".", "+7", " 8"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = {r["i"]: r["v"] for r in df.select("i", lenient_double(F.col("x"), T.StringType()).alias("v")).collect()}
    for i, text in enumerate(texts):
        try:
            want = float(text)
        except ValueError:
            want = None
        if want is not None and math.isnan(want):
            assert math.isnan(got[i])
        else:
            assert got[i] == want, text


def test_round_1_is_pythons_round(spark):
    rnd = random.Random(5)
    values = [s / 60 for s in range(0, 3000, 3)] + [rnd.uniform(-1e6, 1e6) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", round_1(F.col("x")).alias("y")).collect():
        assert r["y"] == round(r["x"], 1), r["x"]

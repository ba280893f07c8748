"""Nearest neighbours by learned partitions against exact search."""

import numpy as np

from talkloom.llm import neighbours


def _exact(rows, query, top):
    own = np.array(dict(rows)[query])
    scored = sorted((-float(np.dot(own, v)), i) for i, v in rows if i != query)
    return [i for _, i in scored[:top]]


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0")).toPandas()
    table = vectors.toPandas().sort_values("vec_id")
    x, ids = np.array(table["embedding"].tolist(), dtype=float), table["vec_id"].to_numpy()
    hits = total = 0
    for query, rows in found.groupby("query_id"):
        assert rows.sort_values("rank")["rank"].tolist() == list(range(1, 21))
        scores = x @ x[ids == query][0]
        scores[ids == query] = -np.inf
        hits += len(set(ids[np.argsort(-scores)[:20]]) & set(rows["vec_id"]))
        total += 20
    assert total == 20 * (ids % 20 == 0).sum() and hits / total >= 0.9


def test_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    same = [(100 + i, [0.5, 0.5, 0.0, 0.0]) for i in range(60)]
    bad = [
        (200, None), (201, [0.0] * 4), (202, [float("nan"), 1.0, 1.0, 1.0]), (203, [1.0, 2.0]),
        (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1.0, None, 0.0, 0.0]), (None, [1.0] * 4),
    ]
    rows = [*good, *same]
    names = "vec_id long, embedding array<double>"
    vectors = spark.createDataFrame([*rows, *bad, rows[0]], names).selectExpr("*", "vec_id as v", "1 as part")
    found = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0 or vec_id >= 200")).toPandas()
    assert set(found["query_id"]) == {i for i, _ in rows if i % 20 == 0}
    for query, hits in found.groupby("query_id"):
        assert hits.sort_values("rank")["vec_id"].tolist() == _exact(rows, query, 20)


def test_many_different_vectors_with_one_score(spark):
    """Of 400 vectors that tie the smallest ids are the answer."""
    rng = np.random.default_rng(2)
    order = rng.permutation(400)
    rows = [(int(order[i]) + 1, [1.0] + [float(b) for b in f"{i:09b}"]) for i in range(400)]
    rows.append((1000, [1.0] + [0.0] * 9))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, vectors.where("vec_id = 1000")).toPandas()
    assert found.sort_values("rank")["vec_id"].tolist() == list(range(1, 21))


def test_few_and_no_rows(spark):
    names = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [1.0, 1.0])], names)
    found = neighbours.nearest(few, few.where("vec_id % 20 = 0")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == [
        (0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 2.0), (20, 2, 0, 0.0),
    ]
    assert neighbours.nearest(few.where("false"), few.where("false")).count() == 0


def test_rows_of_one_id_are_one_row(spark, store):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    twice = [*rows, (20, [-9.0, 0.0, 0.0, 0.0]), (20, [9.0, 0.0, 0.0, 0.0]), (7, [-8.0, 1.0, 1.0, 1.0])]
    vectors = spark.createDataFrame(twice, "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), store=store).toPandas()
    least = {i: min(v for j, v in twice if j == i) for i in range(40)}
    for query, hits in found.groupby("query_id"):
        assert hits.sort_values("rank")["vec_id"].tolist() == _exact(list(least.items()), query, 20)

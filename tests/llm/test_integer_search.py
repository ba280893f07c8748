"""Exact top-k and hard negatives against brute force over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.llm import negatives, threshold


def _usable(rows, with_label=False):
    """{id: (label, whole numbers)} of the rows that take part."""
    out = {}
    for i, v, label in rows:
        if i is None or v is None or not v or (with_label and label is None):
            continue
        if any(x is None or not np.isfinite(x) for x in v) or len(v) != 6:
            continue
        own = (label if with_label else 0, [int(np.floor(256 * x)) for x in v])
        out[i] = min(out.get(i, own), own)
    return out


def _top(rows, step, k):
    kept = _usable(rows)
    want = []
    for q, (_, x) in kept.items():
        if q % step == 0:
            scored = sorted((-int(np.dot(x, v)), i) for i, (_, v) in kept.items() if i != q)[:k]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(want)


def _mined(rows, step, positives=5, many=3):
    kept = _usable(rows, True)
    want = []
    for a, (label, x) in kept.items():
        if a % step:
            continue
        scored = sorted((-int(np.dot(x, v)), i, own) for i, (own, v) in kept.items() if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            ps = -s
            window = [(i, -t) for t, i, own in scored if own != label and 50 * ps <= -100 * t <= 95 * ps]
            want += [(a, p, r, i, ps, ns) for r, (i, ns) in enumerate(window[:many], 1)]
    return sorted(want)


def _rows(kind):
    rng = np.random.default_rng(7)
    if kind == "random":
        v = rng.normal(size=(400, 6))
    elif kind == "coarse":  # many ties
        v = rng.integers(-1, 2, (400, 6)) / 4
    elif kind == "copies":  # a third of all rows alike
        v = rng.normal(size=(400, 6))
        v[rng.permutation(400)[:140]] = v[0]
    else:  # far apart groups, so that blocks can be left out
        v = rng.normal(size=(400, 6)) / 20 + np.repeat(rng.normal(size=(8, 6)), 50, axis=0)
    labels = np.where(rng.random(400) < 0.35, 3, rng.integers(0, 5, 400))
    return [(int(i), v[i].tolist(), int(labels[i])) for i in rng.permutation(400)]


BAD = [
    (600, None, 1), (601, [], 1), (602, [float("nan")] + [1.0] * 5, 1), (603, [1.0, 2.0], 1),
    (604, [float("inf")] * 6, 2), (605, [1.0, None, 0.0, 0.0, 0.0, 0.0], 2), (None, [1.0] * 6, 1),
    (606, [0.0] * 6, 1), (606, [0.0] * 6, 1), (607, [0.5] * 6, None), (608, [0.25] * 6, 4),
    (608, [0.5] * 6, 4), (610, [1000.0] * 6, 2),
]


def _frame(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return frame.selectExpr("*", "label as id", "label as v", "label as block", "label as chunk")


@pytest.mark.parametrize("kind", ["random", "coarse", "copies", "groups"])
def test_against_all_pairs(spark, store, monkeypatch, kind):
    """With blocks and chunks so small that there are many of each."""
    for module in (threshold, negatives):
        monkeypatch.setattr(module, "BLOCK_ROWS", 60)
    monkeypatch.setattr(threshold, "QUERY_CHUNK", 8)
    monkeypatch.setattr(negatives, "ANCHOR_CHUNK", 8)
    monkeypatch.setattr(negatives, "ZONE_GROUP", 4)
    rows = [*_rows(kind), *BAD]
    frame = _frame(spark, rows)
    asked = F.col("id") % 20 == 0
    got = threshold.top_k(frame, asked, store).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == _top(rows, 20, 5)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = negatives.mine(frame, asked, store).select(columns)
    assert sorted(map(tuple, got.collect())) == _mined(rows, 20)


def test_few_and_no_rows(spark, store):
    rows = [(0, [1.0] * 6, 1), (20, [2.0] * 6, 1), (3, [1.5] * 6, 2)]
    asked = F.col("id") % 20 == 0
    few = _frame(spark, rows)
    got = threshold.top_k(few, asked, store).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == _top(rows, 20, 5)
    assert len(negatives.mine(few, asked, store).collect()) == len(_mined(rows, 20)) > 0
    none = few.where("false")
    assert threshold.top_k(none, asked, store).count() == 0
    assert negatives.mine(none, asked, store).count() == 0


def test_reading_stops_early():
    """Far fewer rows are scored than there are, and a floor leaves out a whole block."""
    rng = np.random.default_rng(8)
    matrix = rng.integers(-20, 20, (4_000, 8))
    matrix[17] = 250
    order = np.argsort(matrix, axis=0, kind="stable").T
    lists = threshold.Lists(np.arange(4_000), matrix, order, np.take_along_axis(matrix.T, order, axis=1))
    query = np.array([3, 1, 4, 1, 5, 9, 2, 6])
    ids, scores, scored = threshold.threshold_top(lists, query, -1, 1)
    assert ids.tolist() == [17] and scores.tolist() == [250 * 31] and scored < 400
    assert threshold.threshold_top(lists, query, -1, 1, 10**6)[2] == 0


def test_hilbert_neighbours_are_next_to_each_other():
    """Along the whole curve one step changes one axis by one."""
    for dims, bits in [(2, 3), (3, 2), (5, 2)]:
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = [row.tobytes() for row in negatives.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[np.argsort(np.array(keys, dtype=object))]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_bounds_hold(spark):
    rng = np.random.default_rng(9)
    block, anchors = rng.integers(-200, 200, (50, 6)), rng.integers(-200, 200, (9, 6))
    low, high = negatives._intervals(anchors, block.min(0)[None, :], block.max(0)[None, :])
    scores = anchors @ block.T
    assert (low[:, 0] <= scores.min(1)).all() and (high[:, 0] >= scores.max(1)).all()

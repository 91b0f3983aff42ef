from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import hard_negatives as hn
from tallyworks.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, key string, leaf string"


def brute(rows, is_anchor, scale=256, most=95):
    valid = set()
    for vec_id, v, label in rows:
        if None not in (vec_id, v, label) and all(x is not None and math.isfinite(x) for x in v):
            valid.add((vec_id, label, tuple(math.floor(scale * x) for x in v)))
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2], strict=False))
    result = []
    for a in valid:
        if is_anchor(a[0]):
            others = sorted((-score(a, b), b[0], b[1]) for b in valid if b[0] != a[0])
            for s, positive, _ in [o for o in others if o[2] == a[1]][:5]:
                near = [o for o in others if o[2] != a[1] and -50 * s <= -100 * o[0] <= -most * s][:3]
                result += [(a[0], positive, rank, n, -s, -t) for rank, (t, n, _) in enumerate(near, 1)]
    return sorted(result)


def corpus(seed, n=240, width=5):
    """Clusters, one vector that a third of the rows share, ties, and rows that lack something."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        v = [c + rng.gauss(0, 0.15) for c in rng.choice(centres)]
        if i % 3 == 0:
            v = centres[0]
        if i % 11 == 0:
            v = [round(x) / 4 for x in v]
        rows.append((i - 40, v, rng.randrange(3)))
    nan, inf = float("nan"), float("inf")
    odd = [(None, centres[1], 1), (1000, None, 1), (1010, centres[1], None), (1020, [nan] * width, 1), (1030, [inf] * width, 1)]
    odd += [(1040, [None] * width, 1), (1050, [], 1), (1060, centres[1][:2], 2), rows[60], (rows[60][0], centres[2], 1)]
    return rows + odd


@pytest.mark.parametrize(
    ("seed", "leaf_rows", "block_rows", "group"), [(1, 1024, 16_384, 16_384), (2, 8, 16_384, 16_384), (3, 8, 5, 16_384), (4, 20, 7, 6)]
)
def test_same_as_brute_force(spark, seed, leaf_rows, block_rows, group, monkeypatch):
    monkeypatch.setattr(hn, "LEAST_SAMPLE", 4)
    monkeypatch.setattr(hn.grow, "__defaults__", (4, leaf_rows, 4))
    rows = corpus(seed)
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = hn.hard_negatives(table, F.col("vec_id") % 10 == 0, leaf_rows=leaf_rows, block_rows=block_rows, group=group)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_empty_tables_and_tables_without_anchors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(none, F.col("vec_id") % 10 == 0).collect() == []
    some = spark.createDataFrame([(1, [0.5, 1.0], 1), (2, [0.5, 0.9], 2)], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(some, F.col("vec_id") % 10 == 0).collect() == []
    assert hn.hard_negatives(some, F.col("vec_id") == 1).collect() == []


def test_long_vectors_stay_exact_or_are_an_error(spark):
    rows = [(i, [float(2**22 + i), 3.0], i % 2) for i in range(12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = hn.hard_negatives(table, F.col("vec_id") == 0, scale=128, most=100)
    expected = brute(rows, lambda i: i == 0, 128, 100)
    assert sorted(map(tuple, found.collect())) == expected and max(e[4] for e in expected) > 1 << 57
    with pytest.raises(ValueError, match="64 bits"):
        hn.hard_negatives(table, F.col("vec_id") == 0, scale=1 << 10)


def index_of(x, leaf_rows):
    tree = hn.grow(x[:400], len(x) / 400, leaf_rows=leaf_rows)
    leaf, passed = hn.descend(tree, x)
    ranges, length = hn.Ranges.empty(tree), hn.squares(x)
    for node, rows, far, child in passed:
        for j in np.unique(child):
            mine = child == j
            ranges.low[node.at][:, j], ranges.high[node.at][:, j] = far[mine].min(axis=0), far[mine].max(axis=0)
            ranges.short[node.at][j], ranges.long[node.at][j] = length[rows[mine]].min(), length[rows[mine]].max()
    return tree, ranges, leaf


@pytest.mark.parametrize(("width", "spread", "most_looked"), [(3, 0.3, 0.5), (16, 0.1, 0.5), (64, 1.0, 1.0)])
def test_no_leaf_with_a_row_of_the_window_is_left_out(width, spread, most_looked):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, width))
    x = np.floor(100 * (centres[rng.integers(0, 20, 3000)] + spread * rng.normal(size=(3000, width))))
    tree, ranges, leaf = index_of(x, 100)
    assert tree.leaves > 8
    a = x[:60]
    scores = a @ x.T
    top = np.sort(scores, axis=1)[:, -20]
    lows, highs = np.stack([0.8 * top, np.full(60, 9.0)], 1), np.stack([0.95 * top, np.full(60, 2.0)], 1)  # the second is empty
    looked = hn.needed(tree, ranges, a, lows, highs)
    for i in range(60):
        inside = np.flatnonzero((scores[i] >= lows[i, 0]) & (scores[i] <= highs[i, 0]))
        assert looked[i, leaf[inside]].all()
    assert looked.mean() <= most_looked
    assert not hn.needed(tree, ranges, a, lows[:, 1:], highs[:, 1:]).any()


def test_equal_rows_make_one_leaf():
    tree = hn.grow(np.ones((500, 4)), 1000.0)
    assert tree.leaves == 1 and tree.nodes == []


def test_blocks_of_a_hot_vector_are_bounded(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), 1.0], i % 4) for i in range(900)]
    vectors = hn.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 256)
    index = hn.Index(hn.written(vectors, "vectors"), 50, 40)
    sizes = [r["count"] for r in index.table.groupBy("leaf", "chunk").count().collect()]
    assert sum(sizes) == 900 and max(sizes) < 80


def test_op13_equals_its_sql(spark, sf_dir, duck):
    found = QUERIES["op13_hard_negatives"](spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(duck.execute(ORACLES["op13_hard_negatives"]).fetchall())

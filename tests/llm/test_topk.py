import math
import random

import numpy as np

from barlake.llm.topk import Segments, top_k
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label string, id string, block int"


def brute(rows, asked, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if asked(i)}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, k, **sizes):
    frame = spark.createDataFrame([(*r, "x", "x", 0) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in top_k(frame, frame.where(F.col("vec_id") % 5 == 0), k, **sizes).collect())


def float32(values):
    return [float(np.float32(x)) for x in values]


def test_equals_brute_force_over_blocks(spark):
    rng = random.Random(2)
    rows = [(i, float32(rng.gauss(0, 0.2) for _ in range(12))) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(120)]  # copies: many ties
    got = run(spark, rows, 7, block=64, batch=16)
    assert got == brute(rows, lambda i: i % 5 == 0, 7)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (5, [1.0, -2.0, 3.0]), (7, None), (10, [float("nan"), 1.0]), (15, [None, 1.0]), (None, [1.0]),
        (20, []), (25, [0.0, 0.0]), (3, [float("inf")]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (30, [1.0, 2.0]), (30, [1.0, 2.0]),
        (35, [3.0e6, -3.0e6]), (40, [3.0e6, 3.0e6]),
    ]
    assert run(spark, rows, 3) == brute(rows, lambda i: i % 5 == 0, 3)
    assert run(spark, [], 3) == [] and run(spark, [(5, [1.0])], 3) == []
    assert len(run(spark, rows[:2], 9)) == 2


def test_segments_fall_in_impact():
    matrix = np.array([[5, -3, 0], [1, 200, -7]])
    segments = Segments(matrix)
    total = np.zeros_like(matrix)
    last = 1 << 60
    for rows, dims, impacts in segments.levels:
        assert np.abs(impacts).max() < last
        last = np.abs(impacts).min()
        total[rows, dims] += impacts
    assert (total == matrix).all() and (segments.left[-1] == 0).all()


def test_pairs_are_never_broadcast(spark, plan_of):
    """Every block has a copy of every batch: many times what they are packed from, by which Spark would choose."""
    rows = [(i, [float(i % 7), 1.0]) for i in range(300)]
    frame = spark.createDataFrame([(*r, "x", "x", 0) for r in rows], SCHEMA)
    found = top_k(frame, frame, 3, block=16, batch=16)
    planned = plan_of(found)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, lambda i: True, 3)
    for plan in (planned, plan_of(found)):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan

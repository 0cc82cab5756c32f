"""Exact top-k search against brute force."""

import math
import random

import numpy as np
import pytest

from chronoreg.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def _rows(seed):
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(0, 1), 1) for _ in range(6)], 0) for i in range(250)]
    rows += [(300, rows[7][1], 0), (400, rows[7][1], 0), (500, [0.0] * 6, 0), (600, [-1.5, 2.0], 0), (700, [], 0)]  # ties, zeros, short
    rows += [(800, None, 0), (900, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (1000, [math.nan] * 6, 0), (1100, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], 0)]
    return rows + [(None, [1.0] * 6, 0), rows[3]]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES_A_BLOCK", 40)
    rows = _rows(seed)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10).orderBy("query_id", "rank").collect()]
    usable = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in sorted(i for i in usable if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)[:10]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert got == want


def test_stops_early_when_the_bound_cannot_win():
    rng = np.random.default_rng(1)
    rows = rng.integers(-50, 50, (5000, 4))
    rows[:20] += 1000
    lists = topk.SortedLists(np.arange(5000), rows)
    ids, scores, scored = lists.top(np.array([3, 1, 2, 5]), 10, -1)
    assert scored < 1000 and list(scores) == sorted(rows @ np.array([3, 1, 2, 5]))[::-1][:10]


def test_fewer_rows_than_k_and_empty(spark):
    vectors = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(vectors, vectors).orderBy("query_id").collect()] == [(0, 1, 1, 2 << 20), (1, 1, 0, 2 << 20)]
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).collect() == []

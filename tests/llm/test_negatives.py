import math
import random

import numpy as np
import pytest

from headroom.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    last = lambda i: (i is None, i or 0)
    v = []
    for i, e, label in rows:
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            v.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in e]))
    out = []
    for k, (i, label, q) in enumerate(v):
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(q, r[2])), r, j) for j, r in enumerate(v) if j != k]
        order = lambda x: (-x[0], last(x[1][0]), x[2])
        for ps, p, _ in sorted((x for x in scored if x[1][1] == label), key=order)[:5]:
            fit = sorted((x for x in scored if x[1][1] != label and 50 * ps <= 100 * x[0] <= 95 * ps), key=order)
            out += [(i, p[0], r, x[1][0], ps, x[0]) for r, x in enumerate(fit[:3], 1)]
    return sorted(out, key=str)


def got(spark, rows, schema=SCHEMA):
    return sorted((tuple(r[c] for c in COLUMNS) for r in N.hard_negatives(spark.createDataFrame(rows, schema)).collect()), key=str)


def vectors(seed, n, dims, labels=3):
    rnd = np.random.default_rng(seed)
    return [(i, [float(x) for x in rnd.normal(0.05, 0.1, dims)], int(rnd.integers(labels))) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "rows_a_block"), [(400, 6, 2048), (700, 24, 60), (300, 2, 7)])
def test_matches_brute_force(spark, monkeypatch, n, dims, rows_a_block):
    monkeypatch.setattr(N, "LEAST_ROWS", rows_a_block)
    rows = vectors(n, n, dims)
    assert got(spark, rows) == brute(rows)


def test_ties_repeats_and_one_common_vector(spark, monkeypatch):
    monkeypatch.setattr(N, "LEAST_ROWS", 50)
    rows = vectors(3, 200, 8)
    rows += [(1000 + i, rows[50][1], 5) for i in range(60)] + [(2000 + i, [x * 0.9 for x in rows[50][1]], 1) for i in range(60)] + [rows[100], rows[100]]
    random.Random(1).shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_nulls_lengths_large_values_clashing_columns_and_none(spark):
    nan, inf = float("nan"), float("inf")
    rows = [*vectors(4, 120, 4), (None, [0.1] * 4, 1), (50, None, 1), (50, [0.1, None, 0.1, 0.1], 1), (100, [nan] * 4, 1), (100, [inf] * 4, 2), (150, [0.2] * 4, None), (200, [], 1), (250, [0.1, 0.2], 0), (300, [1e5, -1e6, 1e6, 2.5], 1), (301, [1e5, -1e6, 1e6, 2.25], 1), (302, [1e5, -1e6, 9e5, 2.5], 2)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(*r, 1, "x", 2) for r in rows], f"{SCHEMA}, row int, q string, block int") == brute(rows)
    assert got(spark, []) == []
    assert N.hard_negatives(spark.createDataFrame([(50, [1e30] * 3, 1), (1, [1e30] * 3, 1), (2, [-1e30] * 3, 2)], SCHEMA)).count() == 0


def test_threshold_stops_early():
    rnd = np.random.default_rng(5)
    q = rnd.integers(-50, 50, (5000, 3))
    q[7] = (900, 900, -900)
    lists = N.Lists(np.arange(5000), np.arange(5000), np.zeros(5000, int), q)
    places, scores = lists.scan(np.array([5, 5, -5]), lambda p, s, threshold: threshold < s.max())
    assert len(places) < 200 and places[scores.argmax()] == 7

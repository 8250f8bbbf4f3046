"""Intervals that never miss, and mined rows against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kartotek.llm import hard_negatives as h

ROW = "id long, x array<double>, label int, v string, cell int"


def brute(rows, is_anchor, scale=1, positives=5, negatives=10, low=30, high=90):
    """``rows``: {id: (label, vector)}."""
    vectors = {i: [int(np.floor(c * scale)) for c in x] for i, (_, x) in rows.items()}
    label = {i: y for i, (y, _) in rows.items()}
    out = []
    for a in filter(is_anchor, rows):
        score = {i: sum(p * q for p, q in zip(vectors[a], vectors[i], strict=True)) for i in rows if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if label[i] == label[a]][:positives]:
            band = [i for i in ranked if label[i] != label[a] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, k, n, score[p], score[n]) for k, n in enumerate(band[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, is_anchor, scale=1, parts=3, **kw):
    table = spark.createDataFrame([(i, [float(c) for c in x], y, "v", 1) for i, (y, x) in rows.items()], ROW).repartition(parts)
    return sorted(map(tuple, h.mine(h.usable(table, "id", "x", F.col("label"), scale), F.expr(is_anchor), **kw).collect()))


@pytest.mark.parametrize("d, kind", [(1, "normal"), (3, "normal"), (64, "normal"), (64, "large"), (70, "zeros"), (200, "same")])
def test_the_interval_holds_the_score(d, kind):
    rng = np.random.default_rng(d)
    x = rng.integers(-300, 300, (80, d))
    if kind == "large":
        x = x * 10_000_000 // 300
    if kind == "zeros":
        x[::2] = 0
    if kind == "same":
        x[:] = x[0]
    bits, align = h.encode(x.astype(float))
    anchors, norm, exact = h.Anchors(x[:20].astype(float)), np.sqrt((x.astype(float) ** 2).sum(1)), x[:20] @ x.T
    for i in range(20):
        low, high = anchors.interval(i, bits, norm, align)
        assert (low <= exact[i]).all() and (exact[i] <= high).all()


def test_intervals_leave_rows_out_where_scores_differ():
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((20, 64)) * 100
    x = np.rint(np.repeat(centres, 50, axis=0) + rng.standard_normal((1000, 64)) * 8).astype(np.int64)
    bits, align = h.encode(x.astype(float))
    best = h.Best(5, np.arange(0, 1000, 100), np.arange(10) * 2, x[::100], [[(0, h._LOW, h._HIGH)]] * 10, True)
    labels = np.repeat(np.arange(20), 50)
    for lo in range(0, 1000, 25):
        best.meet(np.arange(lo, lo + 25), labels[lo:lo + 25] * 0 + 0, x[lo:lo + 25], bits[lo:lo + 25], align[lo:lo + 25])
    assert best.scored < 0.5 * best.met


@pytest.mark.parametrize("limits", [{}, {"ANCHORS": 3, "LEAST_CELL": 40, "CELLS": 100, "SLICE": 16}])
@pytest.mark.parametrize("shape", ["random", "clusters", "copies", "hot label", "small"])
def test_equals_brute_force(spark, monkeypatch, limits, shape):
    for name, value in limits.items():
        monkeypatch.setattr(h, name, value)
    rng = np.random.default_rng(5)
    n = 30 if shape == "small" else 300
    x = rng.standard_normal((n, 24)) * 40
    if shape == "clusters":
        x = np.repeat(rng.standard_normal((10, 24)) * 60, n // 10, axis=0) + x / 8
    if shape == "copies":
        x[50:200] = x[50]
    label = np.where(rng.random(n) < 0.8, 1, rng.integers(0, 5, n)) if shape == "hot label" else rng.integers(0, 5, n)
    rows = {i: (int(label[i]), x[i].tolist()) for i in range(n)}
    want = brute(rows, lambda i: i % 10 == 0, 4)
    assert want and mined(spark, rows, "id % 10 = 0", 4) == want


def test_few_rows_and_bands_below_zero(spark):
    rows = {0: (1, [10, 0]), 1: (1, [-5, 3]), 2: (2, [1, 1]), 10: (3, [2, 2]), 3: (2, [0, 5]), 20: (4, [0, 0]), 21: (4, [1, 0]), 4: (2, [0, 0])}
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows, "id % 10 = 0") == want and {r[0] for r in want} == {20}  # a band of zero holds zeros


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [2.0, 1.0], 1), (2, [0.5, 0.9], 2), (None, [9.0, 9.0], 2), (3, None, 2), (4, [], 2), (5, [nan, 1.0], 2),
            (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (8, [1.0, 1.0], None), (9, [1.0, 1.0, 1.0], 2), (11, [3e38, 1.0], 2), (12, [1e300, 1.0], 2),
            (2, [0.5, 0.9], 2), (2, [0.6, 0.9], 3), (1, [2.0, 1.0], 1)]
    table = spark.createDataFrame([(i, x, y, "a", 1) for i, x, y in rows], ROW)
    got = h.mine(h.usable(table, "id", "x", F.col("label"), 256), F.col("id") % 100 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 196608, 256 * 128 + 256 * 230)]
    assert h.mine(h.usable(table.limit(0), "id", "x", F.col("label"), 256), F.col("id") % 100 == 0).collect() == []
    assert h.mine(h.usable(table, "id", "x", F.col("label"), 256), F.lit(False)).collect() == []


def test_large_components_stay_exact(spark):
    big = 1 << 29
    rows = {0: (1, [big, 1]), 1: (1, [big, 3]), 2: (2, [big // 2, 1]), 3: (2, [big // 2, 2]), 4: (2, [big // 2 + 1, 0])}
    assert mined(spark, rows, "id = 0") == brute(rows, lambda i: i == 0)

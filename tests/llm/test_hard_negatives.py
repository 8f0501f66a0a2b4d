"""Hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives as hn
from ledgerloom.llm.hard_negatives import Settings


def brute(rows, every=5, positives=5, negatives=3):
    use = [(i, np.array([float(np.floor(256 * x)) for x in v]), label) for i, v, label in rows if None not in (i, v, label) and all(x is not None and np.isfinite(x) for x in v) and max(map(abs, v), default=0) < 1e5]
    width = max((len(v) for _, v, _ in use), default=0)
    use = [(i, [int(x) for x in v] + [0] * (width - len(v)), label) for i, v, label in use]
    out = []
    for own, (i, v, label) in enumerate(use):
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for at, (j, w, other) in enumerate(use) if at != own)
        for s, j, _ in [x for x in scores if x[2] == label][:positives]:
            hard = [x for x in scores if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(hard[:negatives])]
    return sorted(out)


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    return frame.withColumns({c: F.lit("clash") for c in ("id", "v", "row", "anchor", "cluster", "block", "part", "known", "_l")})


def mined(frame, settings=Settings(), every=5):
    return sorted(map(tuple, hn.mine(frame, F.col("vec_id") % every == 0, F.col("label"), settings=settings).collect()))


@pytest.mark.parametrize("settings", [Settings(), Settings(clusters=5, sample=40, members=7, block=30, chunk=8)])
def test_ties_odd_vectors_and_repeated_rows(spark, settings):
    made = random.Random(4)
    centres = [[made.gauss(0, 0.5) for _ in range(6)] for _ in range(6)]
    rows = [(k, [round(c + made.gauss(0, 0.2), 2) for c in centres[k % 6]], made.randrange(3)) for k in range(260)]
    rows += [(300 + k, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], k % 2) for k in range(120)]
    rows += [(500 + k, [-0.5] * 6, 1) for k in range(4)]
    rows += [(None, [1.0] * 6, 1), (601, None, 1), (605, [float("nan")] * 6, 1), (610, [1.0, None, 1.0], 0), (615, [float("inf")] * 6, 1), (620, [], 1), (625, [2.0], 0), (630, [0.0] * 6, 1), (635, [1.0] * 6, None), (640, [1e300] * 6, 1)]
    rows += [rows[10], rows[10], rows[7], (20, [0.3] * 6, 2)]
    expected = brute(rows)
    assert len(expected) > 300 and mined(vectors(spark, rows).repartition(3), settings) == expected


def test_tables_without_anchors_or_rows(spark):
    rows = [(1, [1.0], 0), (2, [1.0], 1)]
    assert mined(vectors(spark, rows)) == [] and mined(vectors(spark, rows).limit(0)) == []
    assert mined(vectors(spark, [(5, [1.0], 0)])) == []
    few = [(5, [1.0, 0.0], 0), (6, [1.0, 0.0], 0), (7, [0.7, 0.0], 1)]
    assert mined(vectors(spark, few)) == brute(few) == [(5, 6, 1, 7, 65536, 45824)]


def test_walks_end_early_and_are_exact():
    made = np.random.Generator(np.random.PCG64(1))
    centres = made.normal(size=(12, 16))
    x = np.floor(256 * (centres[np.arange(6000) % 12] + 0.05 * made.normal(size=(6000, 16))))
    u = x[::600][:10]
    n = len(u)
    w = hn.Walkers(u, np.arange(0, 6000, 600)[:n], np.zeros(n, int), np.arange(n), np.full(n, -np.inf), np.full(n, np.inf), np.full(n, True), np.full(n, -np.inf))
    near = [k for k in range(n) if k % 12 == 0] or [0]
    one = hn.Walkers(u[near], w.rows[near], w.labels[near], np.arange(len(near)), *(a[near] for a in (w.low, w.high, w.same, w.known)))
    centre = hn.centroids(u[near], 1)[0]
    who, ids, scores, scored = hn.walk(one, centre, x, np.arange(6000), np.arange(6000), np.zeros(6000, int), 5, 64)
    for k in range(len(near)):
        all_scores = x @ one.vectors[k]
        expected = sorted((-s, i) for i, s in enumerate(all_scores.tolist()) if i != one.rows[k])[:5]
        assert sorted(zip((-scores[who == k]).tolist(), ids[who == k].tolist())) == expected
    assert scored < 0.3 * len(near) * 6000


def test_bounds_hold():
    made = np.random.Generator(np.random.PCG64(2))
    x, u = made.normal(size=(500, 4)), made.normal(size=(9, 4)) + 2
    x[:3] = 0
    centre = hn.centroids(u, 1)[0]
    wide, lengths = hn.angles(u, centre)
    away, sizes = hn.angles(x, centre)
    bounds = sizes * np.cos(np.clip(away - wide.max(), 0, np.pi))
    assert (u @ x.T <= lengths[:, None] * bounds + 1e-9).all()

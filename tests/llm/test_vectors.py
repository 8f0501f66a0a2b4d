"""Exact top-k search against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import metric_tree
from ledgerloom.llm.metric_tree import Settings, Tree


def brute(rows, k, every):
    usable = [(i, np.floor(256 * np.array(v))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and max(map(abs, v), default=0) < 1e5]
    out = []
    for own, (q, x) in enumerate(usable):
        if q % every == 0:
            scores = sorted((-int(sum(a * b for a, b in zip(x, y))), i) for at, (i, y) in enumerate(usable) if at != own)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("settings", [Settings(), Settings(pivots=4, tree=40, page=4, queries=3)])
def test_top_k_with_ties_and_odd_vectors(spark, settings):
    made = random.Random(6)
    rows = [(k, [made.gauss(0, 0.3) for _ in range(8)]) for k in range(300)]
    rows += [(300 + k, [0.25] * 8) for k in range(150)]
    rows += [(None, [1.0] * 8), (451, None), (452, [float("nan")] * 8), (453, [None] * 8), (454, [float("inf")] * 8), (455, []), (456, [9.0]), (460, [0.0] * 8)]
    # Repeated rows, repeated ids of queries with the same and another vector, and a component that 64 bits cannot hold.
    rows += [rows[3], rows[3], rows[20], (40, [0.5] * 8), (480, [1e300] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("id", "v", "norm", "row", "query", "_q", "pivot", "tree")})
    found = metric_tree.top_k(frame.repartition(3), 5, F.col("vec_id") % 20 == 0, settings=settings)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 20)


def test_fewer_candidates_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (50, [3.0])], "vec_id long, embedding array<float>")
    found = metric_tree.top_k(frame, 5, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute([(r.vec_id, list(r.embedding)) for r in frame.collect()], 5, 50)
    assert metric_tree.top_k(frame.limit(0), 5, F.lit(True)).collect() == []


def clustered():
    made = np.random.Generator(np.random.PCG64(1))
    centres = made.integers(-400, 400, (20, 16))
    vectors = (centres[np.arange(2000) % 20] + made.integers(-10, 10, (2000, 16))).astype(float)
    return vectors, float((vectors**2).sum(1).max())


def test_bounds_spare_distances():
    vectors, top = clustered()
    tree = Tree.built(np.arange(2000), np.arange(2000), vectors, top, 32)
    computed = 0
    for q in range(0, 2000, 100):
        who, names, scores, some = tree.search(vectors[q : q + 1], np.array([q]), np.array([-np.inf]), top, 5)
        computed += some
        every = vectors @ vectors[q]
        expected = sorted((-s, i) for i, s in enumerate(every.tolist()) if i != q)[:5]
        assert sorted(zip((-scores).tolist(), names.tolist())) == expected
    assert computed < 0.5 * 20 * 2000


def test_stored_distances_bound_every_page():
    vectors, top = clustered()
    tree = Tree.built(np.arange(2000), np.arange(2000), vectors, top, 8)
    lift = lambda x: np.column_stack((x, np.sqrt(np.maximum(0, top - (x**2).sum(1)))))
    points, routes = lift(tree.vectors), lift(tree.routes)

    def inside(page, above):
        first, last = tree.first[page], tree.last[page]
        if above is not None:
            assert abs(np.linalg.norm(routes[page] - routes[above]) - tree.above[page]) < 1e-6
        if tree.leaf[page]:
            held = np.arange(first, last)
            assert np.allclose(np.linalg.norm(points[held] - routes[page], axis=1), tree.near[held])
        else:
            held = np.concatenate([inside(child, page) for child in range(first, last)])
        assert np.linalg.norm(points[held] - routes[page], axis=1).max() <= tree.radius[page] + 1e-6
        return held

    assert sorted(inside(0, None)) == list(range(2000))


def test_many_queries_and_known_scores():
    vectors, top = clustered()
    tree = Tree.built(np.arange(2000), 5000 - np.arange(2000), vectors, top, 16)
    asked = np.arange(0, 2000, 37)
    every = vectors[asked] @ vectors.T
    every[np.arange(len(asked)), asked] = -np.inf
    known = np.sort(every, axis=1)[:, -3]
    for least, k in ((np.full(len(asked), -np.inf), 3), (known, 3), (known + 1, 3), (known * 0 + 1e12, 2)):
        who, names, scores, _ = tree.search(vectors[asked], asked, least, top, k)
        for q in range(len(asked)):
            expected = sorted((-s, 5000 - i) for i, s in enumerate(every[q].tolist()) if s >= least[q])[:k]
            assert sorted(zip((-scores[who == q]).tolist(), names[who == q].tolist())) == expected


@pytest.mark.parametrize("seed", range(4))
def test_edit_distance(seed):
    from ledgerloom.llm.edits import edit_distance

    made = random.Random(seed)
    for _ in range(200):
        x = "".join(made.choice("abé日") for _ in range(made.randint(0, 80)))
        y = x[: made.randint(0, len(x))] + "".join(made.choice("abé") for _ in range(made.randint(0, 6))) + x[made.randint(0, len(x)) :]
        last = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            row = [i]
            for j, b in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
            last = row
        for most in (0, 3, 200):
            assert edit_distance(x, y, most) == min(last[-1], most + 1)


def test_runs_are_whole():
    import pyarrow as pa

    from ledgerloom.llm.runs import whole_runs

    made = random.Random(2)
    runs = sorted(made.randint(0, 30) for _ in range(300))
    batches, at = [], 0
    while at < len(runs):
        n = made.choice([1, 1, 2, 7, 40])
        batches.append(pa.record_batch({"run": pa.array(runs[at : at + n], pa.int64())}))
        at += n
    tables = [t.column("run").to_pylist() for t in whole_runs(iter(batches)) if t.num_rows]
    assert [r for t in tables for r in t] == runs
    assert all(a[-1] != b[0] for a, b in zip(tables, tables[1:]))

"""Cover-tree search against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np

from arbor.llm import topk

from .helpers import clashing


def brute(rows, k, every):
    own = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in own if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in own if j != i and len(w) == len(v))
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def check(spark, rows, k=10, every=100):
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    assert sorted(map(tuple, topk.top_k(df, k, every).collect())) == brute(rows, k, every)


def test_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]),
            (200, [float("inf"), 0.0]), (7, [1.0, 2.0, 3.0]), (300, [0.5, 0.1, 0.2]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (0, [1.0, 2.0])]
    check(spark, rows)
    check(spark, rows + [(1000 + i, [float(i % 7), float(i % 3)]) for i in range(1, 80)])


def test_clusters_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "SAMPLE", 20)
    rng = random.Random(5)
    centers = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(700):
        c = rng.choice(centers)
        rows.append((i, [round(x + rng.gauss(0, 0.05), 1) for x in c]))
    check(spark, rows, k=5, every=20)


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(900, 6)) * 100)
    tree = topk.CoverTree(x)
    for n in range(len(tree.center)):
        own = tree.order[tree.start[n]:tree.stop[n]]
        assert np.sqrt(((x[own] - x[tree.center[n]]) ** 2).sum(axis=1)).max() <= tree.reach[n] + 1e-9
        for c in tree.children[n]:
            assert tree.start[n] <= tree.start[c] <= tree.stop[c] <= tree.stop[n]
    assert sorted(tree.order) == list(range(900))


def test_empty_table_and_no_query(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")).collect() == []


def test_large_components_stay_exact(spark):
    big = [(0, [3e6, 1.0]), (1, [2e6, 5.0]), (2, [2e6, 4.0])]
    check(spark, big)

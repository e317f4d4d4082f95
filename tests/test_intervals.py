"""Interval labels, jump tables and running totals against plain Python, on trees with wide, deep and shared parts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from arbor import Hierarchy, build_index, edges_from
from arbor.operators import direct, indexed, interval, jump
from arbor.plans.materialize import RoundWriter
from arbor.plans.prefix import running_totals

from .conftest import ids_df, pairs_df


def edges_of(spark, pairs):
    return edges_from(spark.createDataFrame(pairs, "src bigint, dst bigint"))


def random_pairs(seed, n=220):
    rng = random.Random(seed)
    pairs = [(i, rng.randrange(max(1, i - 15), i)) for i in range(2, n)]
    pairs += [(1000 + i, 3) for i in range(150)]                       # a wide node
    pairs += [(2000 + i, 1999 + i) for i in range(1, 70)] + [(2000, 7)]  # a deep chain
    return pairs


SHARED = [(30, 5), (31, 5), (40, 30), (40, 31), (41, 40), (30, 6)]  # nodes with several parents


@pytest.fixture(scope="module", params=["tree", "dag"])
def case(spark, request):
    pairs = random_pairs(4)
    if request.param == "dag":
        taken = dict(pairs)
        pairs += [(a, b) for a, b in SHARED if taken.get(a) != b]
    index = build_index(Hierarchy(edges_of(spark, pairs), root=1), -1).cache()
    return index, interval.label_index(index)


def test_labels_number_every_row_once_in_visiting_order(spark, case):
    index, labels = case
    rows = [r.asDict() for r in labels.rows.collect()]
    paths = {(r["id"], r["path"]): r["ancestors"] for r in index.collect()}
    order = sorted(paths, key=lambda k: [*paths[k], k[0]])
    size = {k: sum(paths[o][:len(paths[k]) + 1] == [*paths[k], k[0]] for o in paths) + 1 for k in paths}
    want = {k: (i + 1, i + size[k]) for i, k in enumerate(order)}
    assert {(r["id"], r["path"]): (r["first"], r["last"]) for r in rows} == want and len(rows) == len(want)
    assert labels.tree == (len({r["id"] for r in rows}) == len(rows))


def test_members_as_by_ancestors(spark, case):
    index, labels = case
    asked = spark.range(-2, 2100).select(F.col("id").alias("vid"))
    want = sorted(tuple(r) for r in indexed.subtree_members(index, asked).collect())
    for cap in (0, 3, interval.CAP):  # cells of one number, of 64, and wider than the tree
        own = interval.Labels(labels.rows, labels.tree, cap)
        assert sorted(tuple(r) for r in interval.subtree_members(own, asked).collect()) == want


def test_is_subtree_as_by_ancestors(spark, case):
    index, labels = case
    rng = random.Random(9)
    ids = [*range(1, 60), 1003, 2000, 2030, 2069, -1, 9999]
    q = pairs_df(spark, [(rng.choice(ids), rng.choice(ids)) for _ in range(800)])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(interval.is_subtree(labels, q)) == rows(indexed.is_subtree(index, q))


def test_no_ancestors_and_no_arrays_in_the_plans(spark, case):
    _, labels = case
    for df in (interval.subtree_members(labels, ids_df(spark, [1, 3, 2000])),
               interval.is_subtree(labels, pairs_df(spark, [(5, 1), (1, 5)]))):
        plan = df._jdf.queryExecution().toString().lower()
        assert "ancestors" not in plan and "explode" not in plan and "array" not in plan.replace("arrayseq", "")


def test_empty_and_unknown(spark, case):
    index, labels = case
    none = interval.label_index(index.limit(0))
    assert none.rows.count() == 0 and none.tree
    assert interval.subtree_members(none, ids_df(spark, [1])).collect() == []
    assert interval.subtree_members(labels, ids_df(spark, [-7])).collect() == []
    got = interval.is_subtree(none, pairs_df(spark, [(4, 4), (4, 1)])).collect()
    assert {(r.target, r.source): r.is_subtree for r in got} == {(4, 4): True, (4, 1): False}


def test_jump_paths_as_by_walking(spark):
    pairs = random_pairs(5) + [(5001, 5000), (5002, 5001), (6001, 6002), (6002, 6003), (6003, 6001), (6004, 6003), (6005, 6004), (1, 77), (8, 8000)]
    h = Hierarchy(edges_of(spark, pairs), root=1)
    asked = ids_df(spark, [*range(1, 222), *range(1990, 2072), 5000, 5002, 6001, 6005, 77777, -1])
    jumps = jump.tree_jumps(h)
    rows = lambda df: sorted((r.vid, tuple(r.path)) for r in df.collect())
    got = rows(jump.path_to_root(jumps, asked, 1))
    assert got == rows(direct.path_to_root(h, asked))
    deepest = max(len(p) - 1 for _, p in got)
    assert deepest > 64 and jumps.rounds == len(jumps.levels) <= deepest.bit_length() + 2
    assert {r.node for r in jumps.endless.collect()} == {6001, 6002, 6003, 6004, 6005}
    depth = {r.node: r.depth for r in jump.depths(jumps, h).collect()}
    assert all(depth[v] == len(p) - 1 for v, p in got if p) and depth[1] == 0 and not {5000, 6001, 8000} & set(depth)


def test_jump_rounds_follow_the_logarithm_of_the_depth(spark):
    h = Hierarchy(edges_of(spark, [(i + 1, i) for i in range(1, 300)]), root=1)
    jumps = jump.tree_jumps(h)
    assert [r.path for r in jump.path_to_root(jumps, ids_df(spark, [300]), 1).collect()] == [list(range(1, 301))]
    assert jumps.rounds == 9  # 299 hops
    jumps = jump.build_jumps(spark.createDataFrame([], "node bigint, up bigint"))
    assert jumps.levels == [] and jumps.endless is None


def test_running_totals_across_partitions(spark):
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 1, 1, 2, 3, None]), i, rng.randrange(-5, 9)) for i in range(400)]
    df = spark.createDataFrame(data, "g long, i long, v long").where("g IS NOT NULL").repartition(5)
    out = running_totals(df, "g", ["i"], "v", "s", RoundWriter(spark, "totals"), "t")
    total, want = {}, []
    for g, i, v in data:
        if g is not None:
            total[g] = total.get(g, 0) + v
            want.append((g, i, v, total[g]))
    assert sorted((r.g, r.i, r.v, r.s) for r in out.collect()) == sorted(want)


def test_members_where_a_node_has_other_children_on_other_paths(spark):
    # cycles and a depth limit: rows of one id have different rows below them, and some have none
    pairs = [(2, 1), (3, 1), (4, 2), (4, 3), (5, 4), (6, 5), (2, 6), (7, 6), (8, 4), (8, 4), (9, 8), (10, 3), (4, 10), (11, 10), (12, 11), (3, 12)]
    h = Hierarchy(edges_of(spark, pairs), root=1)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    for index in (build_index(h, -1).cache(), build_index(h, 3).cache(), build_index(h, 4).cache()):
        labels, asked = interval.label_index(index), spark.range(0, 14).select(F.col("id").alias("vid"))
        assert rows(interval.subtree_members(labels, asked)) == rows(indexed.subtree_members(index, asked))
        q = asked.select(F.col("vid").alias("target")).crossJoin(asked.select(F.col("vid").alias("source")))
        assert rows(interval.is_subtree(labels, q)) == rows(indexed.is_subtree(index, q))


def test_rows_are_numbered_in_one_pass_over_many_partitions(spark, monkeypatch):
    written = {}
    plain = RoundWriter.write

    def counted(self, df, tag, split=None):
        out = plain(self, df, tag, split)
        written[tag] = out.count()
        return out

    monkeypatch.setattr(RoundWriter, "write", counted)
    pairs = random_pairs(8) + [(10_000 + i, 2 + i % 100) for i in range(4000)]
    index = build_index(Hierarchy(edges_of(spark, pairs), root=1), -1).cache()
    n = index.count()
    written.clear()
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        labels = interval.label_index(index)
        spans = {(r.first, r.last): (r.depth, r.path) for r in labels.rows.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    # the rows themselves are written once; besides them there is a row for a piece, or for a depth of a piece
    assert written["sizes"] > 1 and sorted(x for x in written.values() if x > n // 4) == [n]
    assert sorted(f for f, _ in spans) == list(range(1, n + 1))
    sizes = dict.fromkeys((r.id for r in index.collect()), 0)
    for r in index.collect():
        for a in [r.id, *r.ancestors]:
            sizes[a] += 1
    assert {r.id: r.last - r.first + 1 for r in labels.rows.collect()} == sizes

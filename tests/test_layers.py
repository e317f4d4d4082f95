"""Nodes without children stay out of the rounds: index build, jump tables, name rows, rejects."""

from __future__ import annotations

import os
import re
import tempfile

import pyarrow.parquet as pq

from arbor import Hierarchy, build_index, edges_from
from arbor.operators import direct, indexed, jump
from arbor.operators.index import spread, store_index
from arbor.operators.rejects import index_rejects
from arbor.operators.vertices import name_rows_of
from arbor.plans.materialize import RoundWriter

from .conftest import ids_df


def wide(spark):
    """Ten nodes below the root, 30 below each of them, four below each of those, and a loop with a tail."""
    pairs = [(i, 1) for i in range(10, 20)] + [(100 + i, 10 + i % 10) for i in range(300)]
    pairs += [(1000 + i, 100 + i % 300) for i in range(1200)] + [(5001, 5002), (5002, 5001), (5003, 5002), (5004, 5003)]
    return Hierarchy(edges_from(spark.createDataFrame(pairs, "src bigint, dst bigint")), root=1)


def written(monkeypatch):
    tags, plain = {}, RoundWriter.write

    def counted(self, df, tag, split=None):
        out = plain(self, df, tag, split)
        tags[tag] = out.count()
        return out

    monkeypatch.setattr(RoundWriter, "write", counted)
    return tags


def test_rounds_of_the_index_build_leave_out_nodes_without_children(spark, monkeypatch):
    tags = written(monkeypatch)
    rows = lambda df: sorted((r.id, r.path, r.depth, r.parent, tuple(r.ancestors)) for r in df.collect())
    index = build_index(wide(spark), -1)
    assert max(n for t, n in tags.items() if t.startswith("round-")) < 20 and tags["layer-0"] == 1200
    assert rows(index) == rows(build_index(wide(spark), -1, method="levels"))


def test_index_copies_shuffle_ids_and_paths_alone(spark):
    index = build_index(wide(spark), -1)
    plan = spread(index, ["path", "id"])._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("RepartitionByExpression")[1].split("\n")[1]
    assert "AS path" in below and "AS ancestors" not in below and "AS depth" not in below


def test_jump_levels_leave_out_nodes_without_children(spark):
    h = wide(spark)
    jumps = jump.tree_jumps(h)
    assert all(level.count() < 20 for level in jumps.levels) and sum(layer.count() for layer in jumps.layers) >= 1500
    assert {r.node for r in jumps.endless.collect()} == {5001, 5002, 5003, 5004}
    asked = ids_df(spark, [1, 1, 10, 105, 1007, 1307, 2100, 5001, 5004, 77, -3])
    rows = lambda df: sorted((r.vid, tuple(r.path)) for r in df.collect())
    assert rows(jump.path_to_root(jumps, asked, 1)) == rows(direct.path_to_root(h, asked))
    depth = {r.node: r.depth for r in jump.depths(jumps, h).collect()}
    assert len(depth) == 1511 and {depth[1], depth[10], depth[105], depth[1007]} == {0, 1, 2, 3} and 5004 not in depth


def test_name_rows_gather_no_ids(spark):
    names = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (0, 0, "d")], "id bigint, ord int, name string")
    out = name_rows_of(names, ids_df(spark, [1, 1, 0, 9]))
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.vid, r.ord, r.name) for r in out.collect()) == [(1, 0, "a"), (1, 1, "b")]


def test_rejects_store_the_edges_once(spark, monkeypatch):
    tags = written(monkeypatch)
    got = {r.id: r.reason for r in index_rejects(wide(spark), 2).collect()}
    assert tags["edges"] == 1514
    assert got == {**dict.fromkeys(range(1000, 2200), "past level"), **dict.fromkeys(range(5001, 5005), "cycle")}


def bundles(spark):
    """20 nodes below the root, 300 with three parents each among them, two nodes below each of these, and a pair that lead to each other."""
    pairs = [(i, 1) for i in range(10, 30)] + [(100 + i, 10 + (i * k + k) % 20) for i in range(300) for k in (1, 2, 4)]
    pairs += [(1000 + i, 100 + i // 2) for i in range(600)] + [(10, 29), (29, 10)]
    return Hierarchy(edges_from(spark.createDataFrame(pairs, "src bigint, dst bigint").distinct()), root=1)


def test_nodes_with_several_parents_leave_the_rounds_as_well(spark, monkeypatch):
    h = bundles(spark)
    tags = written(monkeypatch)
    rows = lambda df: sorted((r.id, r.path, r.depth, r.parent, tuple(r.ancestors)) for r in df.collect())
    index = build_index(h, -1)
    assert tags["peel-edges"] == h.edges.count()
    assert max(n for t, n in tags.items() if t.startswith("round-")) < 60 and tags["layer-1"] > 600
    assert rows(index) == rows(build_index(h, -1, method="levels"))


def test_all_children_are_shuffled_by_parent_and_copies_are_packed(spark):
    h = bundles(spark)
    folder = tempfile.mkdtemp(prefix="arbor-bundles-")
    stored = store_index(build_index(h, -1), f"{folder}/index")
    for copy in ("path", "id", "parent"):
        files = [f"{folder}/index/{copy}/{f}" for f in os.listdir(f"{folder}/index/{copy}") if f.endswith(".parquet")]
        chunks = [g.column(i) for m in map(pq.read_metadata, files) for g in map(m.row_group, range(m.num_row_groups)) for i in range(g.num_columns)]
        assert chunks and {c.compression for c in chunks} == {"ZSTD"} and not any(c.has_dictionary_page for c in chunks)
    asked = h.edges.select("src").unionByName(ids_df(spark, [1, 1, 77]).withColumnRenamed("vid", "src"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = indexed.children(stored, asked, "src")
        plan = got._jdf.queryExecution().executedPlan().toString()
        keys = [k.split(", ") for k in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
        assert any(k[0].startswith("_p#") for k in keys) and not any("ath#" in x for k in keys for x in k), plan
        pairs = lambda df: sorted((r.vid, r.child) for r in df.collect())
        table = indexed.children(build_index(h, -1, method="levels"), asked, "src")
        assert pairs(got) == pairs(table) and len(pairs(got)) > 1400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

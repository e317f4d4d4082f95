"""Stored index: write, read back, and the clustering key of the write."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from arbor import Hierarchy, build_index, edges_from, read_index, write_index
from arbor.operators import indexed
from arbor.operators.index import INDEX_CLUSTERING
from arbor.sources.edges import clustered

from .conftest import ids_df


def rows(df):
    return sorted((r.id, r.path, r.depth, r.parent, tuple(r.ancestors)) for r in df.collect())


def test_round_trip_with_a_very_wide_parent(spark, workdir):
    # node 2 has 3,000 children: every one of them has the path "/1/2/"
    pairs = [(2, 1), (3, 1)] + [(i, 2) for i in range(10, 3010)] + [(5000, 3)]
    e = edges_from(spark.createDataFrame(pairs, "src bigint, dst bigint"))
    idx = build_index(Hierarchy(e, root=1), -1)
    out = os.path.join(workdir, "stored-wide")
    write_index(idx, out)
    back = read_index(spark, out)
    assert rows(back) == rows(idx)
    assert back.where(F.col("path") == "/1/2/").count() == 3000
    got = {r.vid: r.path for r in indexed.path_to_root(back, ids_df(spark, [5000, 2999, 1])).collect()}
    assert got == {5000: [1, 3, 5000], 2999: [1, 2, 2999], 1: []}


def test_write_is_range_partitioned_on_path_then_id(spark):
    e = edges_from(spark.createDataFrame([(2, 1), (3, 2)], "src bigint, dst bigint"))
    idx = build_index(Hierarchy(e, root=1), -1)
    plan = clustered(idx, INDEX_CLUSTERING)._jdf.queryExecution().executedPlan().toString()
    key = plan.split("rangepartitioning(")[1].split(", 4)")[0]
    assert key.startswith("path") and ", id" in key


def test_read_of_a_minimal_index_derives_columns(spark, workdir):
    out = os.path.join(workdir, "stored-minimal")
    spark.createDataFrame([(1, "/"), (2, "/1/"), (7, "/1/2/")], "id bigint, path string").write.parquet(out)
    back = read_index(spark, out)
    got = {r.id: (r.depth, r.parent, list(r.ancestors)) for r in back.collect()}
    assert got == {1: (0, None, []), 2: (1, 1, [1]), 7: (2, 2, [1, 2])}


def test_edge_and_vertex_snapshots_round_trip(spark, mini, workdir):
    from arbor import read_snapshot, write_snapshot

    for name, df, key in (("edges", mini.edges, "src"), ("vertices", mini.vertices, "id")):
        out = os.path.join(workdir, f"snapshot-{name}")
        write_snapshot(df, out, sort_by=key)
        back = read_snapshot(spark, out)
        assert back.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_few_pairs_are_broadcast_into_the_index_join(spark, workdir):
    import re

    pairs = [(2, 1), (3, 1)] + [(i, 2) for i in range(10, 3010)]
    e = edges_from(spark.createDataFrame(pairs, "src bigint, dst bigint"))
    out = os.path.join(workdir, "stored-few-pairs")
    write_index(build_index(Hierarchy(e, root=1), -1), out)
    asked = os.path.join(workdir, "asked-few-pairs")
    spark.createDataFrame([(2999, 2), (2999, 3)], "target bigint, source bigint").write.parquet(asked)
    back, q = read_index(spark, out), spark.read.parquet(asked)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")  # above the pairs file, below the index
    try:
        df = indexed.is_subtree(back, q)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"BroadcastHashJoin \[target#\d+L?\], \[target#\d+L?\], Inner, BuildLeft", plan), plan
        assert {(r.target, r.source): r.is_subtree for r in df.collect()} == {(2999, 2): True, (2999, 3): False}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

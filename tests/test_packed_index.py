"""What copies of an index store, what is read off their paths, and joins that are not judged by the bytes of packed files."""

from __future__ import annotations

import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from arbor import Hierarchy, build_index, edges_from
from arbor.functions.columns import ancestors_of, depth_of, parent_of
from arbor.operators import index as index_module
from arbor.operators.index import store_index
from arbor.plans.materialize import RoundWriter


def bundles(spark):
    pairs = [(i, 1) for i in range(10, 30)] + [(100 + i, 10 + (i * k + k) % 20) for i in range(300) for k in (1, 2, 4)]
    pairs += [(1000 + i, 100 + i // 2) for i in range(600)] + [(10, 29), (29, 10)]
    return Hierarchy(edges_from(spark.createDataFrame(pairs, "src bigint, dst bigint").distinct()), root=1)


def rows(df):
    return sorted((r.id, r.path, r.depth, r.parent, tuple(r.ancestors)) for r in df.collect())


def test_paths_are_stored_and_ancestors_read_off_them(spark):
    h, folder = bundles(spark), tempfile.mkdtemp(prefix="arbor-packed-")
    stored = store_index(build_index(h, -1), f"{folder}/index")
    for copy, columns in {"path": ["id", "path", "depth", "parent"], "id": ["id", "path"], "parent": ["id", "path", "parent"]}.items():
        files = [f for f in os.listdir(f"{folder}/index/{copy}") if f.endswith(".parquet")]
        assert files and all(pq.read_schema(f"{folder}/index/{copy}/{f}").names == columns for f in files)
    want = rows(build_index(h, -1, method="levels"))
    assert rows(stored.by_path) == want and rows(stored.lookup("id")) == want
    assert sorted((r.id, r.path) for r in stored.lookup("parent").collect()) == sorted(r[:2] for r in want)


def test_paths_of_any_form_give_what_their_parts_say(spark):
    paths = ["/", "", "/1/", "/1/22/333/", "/1/2", "1/2/", "//1//2/", "/1//", "//", "/-4/5/", None]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = df.select("path", ancestors_of(F.col("path")).alias("a"), depth_of(F.col("path")).alias("d"), parent_of(F.col("path")).alias("p")).collect()
    for r in got:
        if r.path is None:
            assert r.a is None and r.p is None
            continue
        parts = [int(x) for x in r.path.split("/") if x]
        assert (r.a, r.d, r.p) == (parts, len(parts), parts[-1] if parts else None), r.path


def test_layers_with_many_rows_above_them_are_not_joined_by_a_broadcast(spark, monkeypatch):
    plans, plain = {}, RoundWriter.write

    def kept(self, df, tag, split=None):
        plans[tag] = df._jdf.queryExecution().executedPlan().toString()
        return plain(self, df, tag, split)

    monkeypatch.setattr(RoundWriter, "write", kept)
    monkeypatch.setattr(index_module, "FEW_ROWS", 10)
    got = rows(build_index(bundles(spark), -1))
    assert "SortMergeJoin" in plans["layer-0"] and "BroadcastHashJoin" not in plans["layer-0"], plans["layer-0"]
    assert got == rows(build_index(bundles(spark), -1, method="levels"))

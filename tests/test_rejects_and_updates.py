"""What an index leaves out, edge changes, sibling classes, patterns by trigrams, pushed lookups, early stops, small task results."""

from __future__ import annotations

import glob
import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from arbor import Hierarchy, build_index, build_vertices, edges_from
from arbor.operators import direct, indexed, jump, trigrams, walk
from arbor.operators.index import among, few_ids, is_small, store_index
from arbor.operators.rejects import index_rejects
from arbor.operators.update import changed_hierarchy, update_index, update_stored
from arbor.operators.vertices import find_id_like
from arbor.plans.materialize import RoundWriter
from arbor.plans.skew import SkewConf, heavy_keys

from .conftest import ids_df, pairs_df

PAIRS = "src bigint, dst bigint"


def edges_of(spark, pairs):
    return edges_from(spark.createDataFrame(pairs, PAIRS))


def index_rows(df):
    return sorted((r.id, r.path, r.depth, r.parent, tuple(r.ancestors)) for r in df.collect())


def test_every_node_left_out_has_one_reason(spark):
    pairs = [(2, 1), (3, 2), (4, 3), (5, 4),        # 4 and 5 are past level 2
             (20, 21), (22, 20),                    # 21 has no parent
             (30, 31), (31, 30), (32, 31), (33, 32),  # a cycle and what hangs on it
             (40, 30), (40, 21),                    # below a cycle and below a top: an orphan
             (50, 32), (50, 2),                     # below a cycle and below the root: indexed
             (1, 60), (61, 60)]                     # above the root
    h = Hierarchy(edges_of(spark, pairs), root=1)
    reasons = {r.id: r.reason for r in index_rejects(h, 2).collect()}
    assert reasons == {4: "past level", 5: "past level", 20: "orphan", 21: "orphan", 22: "orphan", 40: "orphan", 60: "orphan", 61: "orphan",
                       30: "cycle", 31: "cycle", 32: "cycle", 33: "cycle"}
    for level in (-1, 2):
        left = {r.id for r in index_rejects(h, level).collect()}
        held = {r.id for r in build_index(h, level).collect()}
        assert not left & held and left | held == {x for p in pairs for x in p}
    assert index_rejects(Hierarchy(spark.createDataFrame([], "src bigint, dst bigint, relationship string"))).collect() == []


def test_rejects_with_salted_parents(spark):
    pairs = [(i, 1) for i in range(2, 80)] + [(i, 5) for i in range(100, 200)] + [(300 + i, 300) for i in range(1, 90)]
    plain, salted = (Hierarchy(edges_of(spark, pairs), root=1, skew=s) for s in (None, SkewConf(min_rows=10, max_keys=8, max_buckets=8)))
    rows = lambda h: sorted(tuple(r) for r in index_rejects(h, 1).collect())
    assert rows(plain) == rows(salted) and len(rows(plain)) == 190


CHANGES = {
    "move a subtree": ([(10, 3)], [(10, 2)]),
    "cut a subtree off": ([], [(10, 2)]),
    "join an orphan": ([(90, 4)], []),
    "a second parent": ([(11, 3)], []),
    "swap above each other": ([(3, 10), (10, 1)], [(3, 1), (10, 2)]),
    "close a cycle": ([(2, 12)], [(2, 1)]),
    "nothing new": ([(10, 2)], [(77, 76)]),
    "the root's edge": ([(1, 4)], []),
    "a new leaf, twice": ([(500, 12), (500, 12), (501, 500)], []),
}
TREE = [(2, 1), (3, 1), (4, 3), (10, 2), (11, 10), (12, 11), (13, 10), (91, 90), (92, 91)] + [(i, 4) for i in range(200, 240)]


def apart(pairs, k):
    """``pairs`` with ids of their own under the one root."""
    return [tuple(x if x == 1 else x + 1000 * k for x in p) for p in pairs]


def all_cases(spark):
    """Every change in a copy of the tree of its own, all under one root."""
    tree = [p for k in range(len(CHANGES)) for p in apart(TREE, k)]
    added, removed = ([p for k, c in enumerate(CHANGES.values()) for p in apart(c[i], k)] for i in (0, 1))
    return Hierarchy(edges_of(spark, tree), root=1), spark.createDataFrame(added, PAIRS), spark.createDataFrame(removed, PAIRS)


def test_updated_index_equals_a_full_build(spark):
    h, added, removed = all_cases(spark)
    index = build_index(h, -1)
    after = changed_hierarchy(h, added, removed)
    want = index_rows(build_index(after, -1, method="levels"))
    stored = store_index(index, tempfile.mkdtemp(prefix="arbor-update-") + "/index")
    new = update_stored(stored, h, added, removed)
    assert index_rows(new.by_path) == want and index_rows(new.lookup("id")) == want
    assert sorted((r.id, r.path, r.parent) for r in new.lookup("parent").collect() if r.parent) == [(i, p, x) for i, p, _, x, _ in want if x]
    assert index_rows(stored.by_path) == index_rows(index)  # the old one is as it was
    # an updated index is updated again
    more = spark.createDataFrame([(4, 3)], PAIRS)
    assert index_rows(update_stored(new, after, more.limit(0), more).by_path) == index_rows(
        build_index(changed_hierarchy(after, more.limit(0), more), -1, method="levels"))


def test_update_of_a_limited_index(spark):
    h = Hierarchy(edges_of(spark, TREE), root=1)
    added, removed = spark.createDataFrame([(10, 4)], PAIRS), spark.createDataFrame([(10, 2)], PAIRS)
    got = update_index(build_index(h, 3), h, added, removed, max_level=3)
    assert index_rows(got) == index_rows(build_index(changed_hierarchy(h, added, removed), 3))


def test_update_keeps_untouched_files(spark):
    pairs = [(i, i // 2) for i in range(2, 3000)]
    h = Hierarchy(edges_of(spark, pairs), root=1)
    stored = store_index(build_index(h, -1), tempfile.mkdtemp(prefix="arbor-files-") + "/index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = store_index(build_index(h, -1), stored.path + "-many")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    before = set(stored.lookup("id").inputFiles())
    new = update_stored(stored, h, spark.createDataFrame([(2900, 7)], PAIRS), spark.createDataFrame([(2900, 1450)], PAIRS))
    kept = before & set(new.lookup("id").inputFiles())
    assert len(before) > 2 and len(kept) == len(before) - 1


def test_sibling_classes_are_linear_and_expand_asked_ids(spark):
    pairs = [(i, 1) for i in range(2, 60)] + [(i, 5) for i in range(100, 180)] + [(100, 6), (300, 6)]
    h = Hierarchy(edges_of(spark, pairs), root=1)
    index = build_index(h, -1)
    hot = Hierarchy(h.edges, root=1, skew=SkewConf(min_rows=10, max_keys=8, max_buckets=8)).hot_parents()
    rows = sorted(tuple(r) for r in indexed.sibling_classes(index).collect())
    assert rows == sorted(tuple(r) for r in indexed.sibling_classes(index, hot).collect()) and len(rows) == index.count() - 1
    sizes = {}
    for p, path, _, _ in rows:
        sizes[p, path] = sizes.get((p, path), 0) + 1
    assert all(n == sizes[p, path] for p, path, _, n in rows)
    asked = ids_df(spark, [2, 100, 300, 1, 999])
    for classes, how in ((indexed.sibling_classes(index), None), (indexed.sibling_classes(index, hot), hot)):
        got = sorted(tuple(r) for r in indexed.siblings_in(classes, asked, hot=how).collect())
        assert got == sorted(tuple(r) for r in indexed.siblings(index, asked).collect())


NAMES = [(1, ["all", "root"]), (2, ["Homo sapiens", "man"]), (3, ["Homo sapiens Linnaeus, 1758"]), (4, ["a"]), (5, ["ab", "b%c"]), (6, ["mann", "é"]),
         (7, [""]), (8, ["100%"]), (9, ["under_score"]), (10, ["man"])]


def test_patterns_by_trigrams_as_one_like_each(spark):
    records = [(i, o, n) for i, names in NAMES for o, n in enumerate(names)]
    v = build_vertices(spark.createDataFrame(records, "id bigint, ord int, name string")).cache()
    patterns = ["man", "Homo sapiens", "Homo%", "%sapiens", "H_mo%", "a", "_", "%", "b%", "ab", "1758", " 1758", "missing", "é", "100%", "under_score",
                "und_r%", "%%", "", None, "man", "_n", "xyzzy%", "root,", "sapiens,man", "l%t"]
    q = spark.createDataFrame([(p,) for p in patterns], "name string")
    got = {r["name"]: r.vid for r in trigrams.find_ids_like(trigrams.build_postings(v), q).collect()}
    assert got == {p: find_id_like(v, p).first().vid for p in set(patterns) if p is not None}


def test_patterns_join_postings_without_a_cross_join(spark):
    records = [(i, 0, f"name {i} {'x' * (i % 7)}") for i in range(500)]
    posts = trigrams.build_postings(build_vertices(spark.createDataFrame(records, "id bigint, ord int, name string")))
    df = trigrams.find_ids_like(posts, spark.createDataFrame([("name 4%",), ("%77%",), ("name 499 %",)], "name string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert {r["name"]: r.vid for r in df.collect()} == {"name 4%": 4, "%77%": 77, "name 499 %": 499}
    assert trigrams.find_ids_like(posts, spark.createDataFrame([], "name string")).collect() == []


def stored_questions(spark, ids):
    path = tempfile.mkdtemp(prefix="arbor-asked-") + "/ids"
    ids_df(spark, ids).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_one_id_reads_one_row_group(spark):
    pairs = [(i, i // 3 if i > 3 else 1) for i in range(2, 30_000)]
    h = Hierarchy(edges_of(spark, pairs), root=1)
    idx = store_index(build_index(h, -1), tempfile.mkdtemp(prefix="arbor-groups-") + "/index", row_group=64 << 10)
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", "true")
    df = indexed.path_to_root(idx, stored_questions(spark, [20_011]))
    assert [r.path for r in df.collect()] == [[*reversed([20_011 // 3 ** k for k in range(10) if 20_011 // 3 ** k])]] or df.count() == 1
    plan = df._jdf.queryExecution().executedPlan()
    read = rows_scanned(plan.toString(), idx, spark)
    assert 0 < read < 30_000 / 4


def rows_scanned(plan, idx, spark):
    """Rows that the scan of the lookup hands on: whole row groups that its filters leave."""
    assert "PushedFilters: [In(id, [20011])" in plan or "EqualTo(id,20011)" in plan, plan
    scan = idx.lookup("id").where(among("id", [20_011])).select("id")
    seen = scan._jdf.queryExecution()
    spark._jvm.org.apache.spark.sql.classic  # noqa: B018  (the metrics are read from the plan that ran)
    scan_plan = seen.executedPlan()
    seen.toRdd().count()
    node = scan_plan
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_only_small_question_sets_are_looked_at(spark):
    assert is_small(stored_questions(spark, [3, 1, 3])) and not is_small(spark.range(10**6))
    assert few_ids(stored_questions(spark, [3, 1, 3]), "vid") == [1, 3]
    assert few_ids(stored_questions(spark, range(400)), "vid") is None
    assert [r.id for r in spark.range(50).where(among("id", list(range(5, 37)))).collect()] == list(range(5, 37))
    assert spark.range(5).where(among("id", [])).count() == 0


def test_questions_run_once(spark):
    h = Hierarchy(edges_of(spark, [(i, i // 2) for i in range(2, 200)]), root=1)
    idx = store_index(build_index(h, -1), tempfile.mkdtemp(prefix="arbor-once-") + "/index")
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    small = spark.range(1, 100).select(F.col("id").alias("vid")).mapInArrow(count, "vid long")
    assert indexed.path_to_root(idx, small).count() == 99 and runs.value == 99
    large = spark.range(10**6).where("id BETWEEN 1 AND 99").select(F.col("id").alias("vid")).mapInArrow(count, "vid long")
    indexed.path_to_root(idx, large)
    assert runs.value == 99


def rounds_of(monkeypatch):
    tags = []
    write = RoundWriter.write
    monkeypatch.setattr(RoundWriter, "write", lambda self, df, tag, split=None: (tags.append(tag), write(self, df, tag, split))[1])
    return lambda: sum(t.startswith("round-") for t in tags)


def test_walks_stop_at_the_last_asked_source(spark, monkeypatch):
    n = 60
    h = Hierarchy(edges_of(spark, [(i + 1, i) for i in range(1, n)]), root=1)
    count = rounds_of(monkeypatch)
    got = {(r.target, r.source): r.is_subtree for r in direct.is_subtree(h, pairs_df(spark, [(60, 58), (60, 57), (50, 49), (60, 60)])).collect()}
    assert got == {(60, 58): True, (60, 57): True, (50, 49): True, (60, 60): True} and count() == 3
    before = count()
    depths = jump.depths(jump.tree_jumps(h), h)
    q = pairs_df(spark, [(60, 58), (55, 59), (40, 777)])
    rounds = lambda: count() - before
    got = {(r.target, r.source): r.is_subtree for r in direct.is_subtree(h, q, depths=depths).collect()}
    assert got == {(60, 58): True, (55, 59): False, (40, 777): False} and rounds() == 2


def test_walks_with_many_sources_loops_and_the_root(spark):
    pairs = [(i, i // 2) for i in range(2, 400)] + [(900, 901), (901, 902), (902, 900), (903, 902), (904, 903), (950, 951)]
    h = Hierarchy(edges_of(spark, pairs), root=1)
    parent = dict(pairs)

    def above(t):
        out = set()
        while t in parent and t != 1 and parent[t] not in out:
            t = parent[t]
            out.add(t)
        return out

    rng = random.Random(1)
    q = {(t, s) for t in (399, 200, 1, 904, 900, 950, 5000) for s in [*range(1, 300), 900, 901, 902, 903, 904, 951, t, -4]}
    q |= {(rng.randrange(1, 400), rng.randrange(1, 400)) for _ in range(300)}
    got = {(r.target, r.source): r.is_subtree for r in direct.is_subtree(h, pairs_df(spark, sorted(q))).collect()}
    assert got == {(t, s): t == s or s in above(t) for t, s in q}


def test_heavy_keys_are_few_by_their_share(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 300, 1).when(F.col("id") < 500, 2).otherwise(F.col("id")).alias("k"))
    conf = SkewConf(min_rows=10, max_keys=4)
    assert sorted(r["key"] for r in heavy_keys(df, "k", conf, 1000).collect()) == [1]
    assert sorted(r["key"] for r in heavy_keys(df, "k", SkewConf(min_rows=10, max_keys=100), 1000).collect()) == [1, 2]


EVENTS = """
import sys, random
sys.path.insert(0, {repo!r})
from arbor.plans.session import local_session
from arbor import Hierarchy, edges_from
from arbor.operators import direct
spark = local_session(cpus=2, shuffle_partitions=2, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {events!r},
    "spark.eventLog.compress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.eventLog.rolling.enabled": "false", "arbor.skew.minRows": "1000"}})
n = 120000
df = spark.range(2, n).selectExpr("id AS src", "CASE WHEN id < 40000 THEN 1 ELSE id - 39000 END AS dst")
h = Hierarchy(edges_from(df), root=1)
out = direct.path_to_root(h, spark.range(1, n).withColumnRenamed("id", "vid"))
assert out.count() == n - 1
spark.stop()
"""


def test_walk_rounds_send_little_to_the_driver(workdir):
    import os
    import subprocess
    import sys

    events = tempfile.mkdtemp(prefix="arbor-events-")
    repo = os.path.abspath(os.path.join(os.path.dirname(os.path.abspath(walk.__file__)), "..", ".."))
    subprocess.run([sys.executable, "-c", EVENTS.format(repo=repo, events="file://" + events)], check=True, timeout=300, capture_output=True)
    sizes = []
    for path in glob.glob(events + "/*"):
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                sizes.append(e["Task Metrics"]["Result Size"])
    assert len(sizes) > 10 and max(sizes) < 100_000

"""Upward walks over a one-parent-per-child table, for many start ids at once.

Each round joins the still-walking rows with ``(src, parent)`` on the current
node and classifies every row as finished or still walking. The round is written
once to the checkpoint folder as a piece of the answer, the walking rows are the
next round's input, and the driver learns only how many rows still walk (an
``Observation`` on the write). Rounds = depth of the deepest start node; neither
the plan nor a row grows with them. A walk notices a loop when it comes back to
a marked node, which is moved on at hops that are powers of two.

The walking side can be skewed: many start ids share an ancestor, so from the
second round on one current node can hold a large share of the walkers. The
parent table is laid out once (partitioned and sorted by node, persisted), so
the sort-merge join reads it without a shuffle -- which also means AQE cannot
split a skewed partition of that join. So a round that left at least
``arbor.skew.minRows`` walkers counts them per node from its written rows (partial
counts in tasks, sums in reducers; only nodes past a threshold that at most
``arbor.skew.maxKeys`` nodes can pass leave a reducer). In the next round, walkers at
those nodes join a broadcast of just those nodes' parent rows where they are, and
only the other walkers are shuffled to the sort-merge join. Which nodes are hot only
routes rows: any choice gives exactly the same answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import empty_ids
from ..plans.layout import keyed
from ..plans.materialize import RoundWriter
from ..plans.skew import SkewConf, heavy_keys

_GO = "go"
#: Sources that a walking row asks for, about.
CHUNK = 64


def _lookup(active: DataFrame, p: DataFrame, hot: list[int]) -> DataFrame:
    """``active`` left-joined with the keyed parent table on ``cur``; walkers at ``hot`` nodes use a
    broadcast of those nodes' parent rows (``hot`` holds at most ``max_keys`` ids)."""
    if not hot:
        return active.join(p, F.col("cur") == F.col("_ps"), "left")
    hk = F.broadcast(active.sparkSession.createDataFrame([(int(k),) for k in hot], "_hk bigint"))
    at_hot = F.col("cur") == F.col("_hk")
    hot_rows = p.join(hk, F.col("_ps") == F.col("_hk"), "left_semi")  # at most max_keys rows
    j_hot = active.join(hk, at_hot, "left_semi").join(F.broadcast(hot_rows), F.col("cur") == F.col("_ps"), "left")
    j_cold = active.join(hk, at_hot, "left_anti").join(p, F.col("cur") == F.col("_ps"), "left")
    return j_cold.unionByName(j_hot)


def _hot_nodes(walkers: DataFrame, walking: int, conf: SkewConf) -> list[int]:
    """Nodes with very many of the ``walking`` walkers: ``max_keys`` at most."""
    if walking < conf.min_rows:
        return []
    return [r["key"] for r in heavy_keys(walkers, "cur", conf, walking).collect()]


def _rounds(name: str, active: DataFrame, parents: DataFrame, step, conf: SkewConf | None = None,
            walking: int = 0, keep_open: bool = False) -> DataFrame:
    """Run rounds until no row walks; ``step(joined, n)`` adds ``_status`` and the next round's columns.

    ``walking`` is given where rows may share their node from the start (then ``active`` is a stored table).
    Returns the finished rows of every round as one Parquet scan (with ``keep_open`` all rows of every round)."""
    writer = RoundWriter(active, name)
    conf = conf or SkewConf.from_session(active.sparkSession)
    # a prepared table (``Hierarchy.walk_table()``) is used as it is and left persisted
    owned = not {"_ps", "_pp"} <= set(parents.columns)
    p = keyed(parents.select(F.col("src").alias("_ps"), F.col("parent").alias("_pp")), "_ps") if owned else parents
    tags: list[str] = []
    schema = None
    hot = _hot_nodes(active, walking, conf)
    try:
        n = 0
        while True:
            n += 1
            staged = step(_lookup(active, p, hot), n)
            obs = Observation(f"{name}{n}")
            left = F.sum(F.when(F.col("_status") == _GO, 1).otherwise(0)).alias("go")
            wrote = writer.write(staged.observe(obs, left), f"round-{n}", split="_status")
            tags.append(f"round-{n}")
            schema = wrote.schema
            walking = obs.get["go"]
            if not walking:
                break
            active = wrote.where(F.col("_status") == _GO).drop("_status")
            hot = _hot_nodes(active, walking, conf)
    finally:
        if owned:
            p.unpersist()
    if keep_open:
        return writer.read(tags, schema)
    writer.release("_status", keep=("none", "root", "loop", "met", "far"))  # walking rows went on in the next round
    return writer.read(tags, schema).where(F.col("_status") != _GO)


def _moved_mark(n: int):
    """The marked node after hop ``n``: at powers of two the node just reached. A walk that comes back to its mark loops."""
    return F.col("cur") if n & (n - 1) == 0 else F.col("mark")


def walk_paths(parents: DataFrame, ids: DataFrame, root: int, id_col: str = "vid",
               conf: SkewConf | None = None) -> DataFrame:
    """``parents`` is ``(src, parent)``, or a prepared ``Hierarchy.walk_table()``.

    ``(vid, path)``: root-first path ending in ``vid``; ``[]`` for the root, unknown ids, and chains
    that stop before the root or loop. A round writes one node per walker, whatever its depth; the
    nodes of a walk, as many as the tree is deep, come together once, at the end."""
    q = ids.select(F.col(id_col).cast("bigint").alias("vid")).where(F.col("vid").isNotNull()).distinct()
    at_root = q.where(F.col("vid") == F.lit(root)).select("vid", empty_ids().alias("path"))
    active = q.where(F.col("vid") != F.lit(root)).select("vid", F.col("vid").alias("cur"), F.col("vid").alias("mark"))

    def step(j: DataFrame, n: int) -> DataFrame:
        staged = j.select("vid", F.col("_pp").alias("cur"), "mark", F.lit(n).alias("hop"))
        status = (F.when(F.col("cur").isNull(), F.lit("none"))
                  .when(F.col("cur") == F.lit(root), F.lit("root"))
                  .when(F.col("cur") == F.col("mark"), F.lit("loop"))
                  .otherwise(F.lit(_GO)))
        return staged.withColumn("_status", status).withColumn("mark", _moved_mark(n))

    rows = _rounds("walk-path", active, parents, step, conf, keep_open=True)
    node = F.when(F.col("cur").isNotNull(), F.struct((-F.col("hop")).alias("h"), F.col("cur").alias("n")))
    walks = rows.groupBy("vid").agg(F.array_sort(F.collect_list(node)).alias("_l"), F.max(F.col("_status") == F.lit("root")).alias("_there"))
    path = F.when(F.col("_there"), F.concat(F.transform("_l", lambda x: x["n"]), F.array("vid"))).otherwise(empty_ids())
    return at_root.unionByName(walks.select("vid", path.alias("path")))


def _chunks(pairs: DataFrame, depths: DataFrame | None, writer: RoundWriter) -> tuple[DataFrame, int]:
    """``vid, chunk, cur, open, met, mark, far``: the sources asked for each target, about ``CHUNK`` to a row."""
    sizes = pairs.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).alias("_of"))
    dealt = pairs.join(sizes, "target").withColumn("chunk", F.pmod(F.xxhash64("source"), F.col("_of")))
    far = F.lit(None).cast("bigint")
    if depths is not None:  # hops up to the highest source; one that is not above the target's depth is never met
        up, down = (depths.select(F.col("node").alias(n), F.col("depth").alias(f"_{n}")) for n in ("target", "source"))
        dealt = dealt.join(up, "target", "left").join(down, "source", "left")
        far = F.max(F.coalesce(F.col("_target") - F.col("_source"), F.lit(0))).alias("far")
    rows = dealt.groupBy(F.col("target").alias("vid"), "chunk").agg(F.collect_list("source").alias("open"), *([far] if depths is not None else []))
    rows = rows.select("vid", "chunk", F.col("vid").alias("cur"), "open", empty_ids().alias("met"), F.col("vid").alias("mark"),
                       F.col("far") if depths is not None else far.alias("far"))
    seen = Observation("chunks")
    stored = writer.write(rows.observe(seen, F.count(F.lit(1)).alias("n")), "chunks")
    return stored, seen.get["n"]


def walk_is_subtree(parents: DataFrame, pairs: DataFrame, root: int, target_col: str = "target", source_col: str = "source",
                    conf: SkewConf | None = None, depths: DataFrame | None = None) -> DataFrame:
    """``(target, source, is_subtree)`` per distinct pair.

    True when the ids are equal (known or not) or ``source`` is met walking up
    from ``target`` (the root included); false otherwise. A target walks with the
    sources that it is asked with, about ``CHUNK`` of them to a walking row (a target asked
    with very many has several), and stops as soon as all of them are met, at the
    root, or where the chain ends or loops. With ``depths`` (``node, depth``) it also stops
    at the depth of its highest source. A row holds its open and met sources and one
    marked node, which is moved on at every power of two: a walk that comes back to the
    mark is in a loop, so no chain is kept.
    """
    q = pairs.select(F.col(target_col).cast("bigint").alias("target"),
                     F.col(source_col).cast("bigint").alias("source")).dropna().distinct()
    same = F.col("target") == F.col("source")
    writer = RoundWriter(pairs, "walk-subtree")
    q = writer.write(q, "pairs")
    active, walking = _chunks(q.where(~same), depths, writer)

    def step(j: DataFrame, n: int) -> DataFrame:
        par = F.col("_pp")
        hit = F.array_contains(F.col("open"), par)
        left = F.when(hit, F.array_remove(F.col("open"), par)).otherwise(F.col("open"))
        met = F.when(hit, F.concat(F.col("met"), F.array(par))).otherwise(F.col("met"))
        staged = j.select("vid", "chunk", par.alias("cur"), left.alias("open"), met.alias("met"), "mark", "far")
        status = (F.when(F.col("cur").isNull(), F.lit("none"))
                  .when(F.size("open") == 0, F.lit("met"))
                  .when(F.col("cur") == F.lit(root), F.lit("root"))
                  .when(F.col("cur") == F.col("mark"), F.lit("loop"))
                  .when(F.col("far") <= n, F.lit("far"))
                  .otherwise(F.lit(_GO)))
        return staged.withColumn("_status", status).withColumn("mark", _moved_mark(n))

    # the root has no parent here, and no source is above it
    at_root = active.where(F.col("vid") == F.lit(root)).select("vid", "met", "open")
    active = active.where(F.col("vid") != F.lit(root))
    done = _rounds("walk-subtree", active, parents, step, conf, walking).select("vid", "met", "open").unionByName(at_root)
    answers = done.select("vid", F.explode("met").alias("source"), F.lit(True).alias("is_subtree")).unionByName(
        done.select("vid", F.explode("open").alias("source"), F.lit(False).alias("is_subtree")))
    return q.where(same).withColumn("is_subtree", F.lit(True)).unionByName(answers.withColumnRenamed("vid", "target"))

"""Jump tables: the 2^k-th ancestor of every node, stored by k.

Level 0 holds each node's parent, level k + 1 joins level k with itself. A node has a row on
level k when it has that many ancestors, so levels shrink, and a tree of depth D has
about log2(D) of them. Once stored,

* a few ids reach the root in as many joins as there are levels (:func:`path_to_root`),
  instead of one round per hop: the nodes found so far, each moved by 2^k, for falling k,
  are all ancestors, each once;
* sums over all ancestors or all descendants of every node take as many rounds
  (:func:`ancestor_sums`, :func:`descendant_sums`): what lies within 2^k steps is extended
  by what lies within 2^k steps of the node 2^k steps away.

All joins are between stored tables, so Spark splits a node that very many rows point to.

A hierarchy's table (:func:`tree_jumps`) is built over its core: layers of nodes without children
further in hang on it by their parent, so the many nodes at the bottom of a wide tree are on no level.
What is asked of them is asked of their parents and extended by one join for each layer.

Nodes on or above a cycle's reach never run out of ancestors: building stops when a level has
as many rows as the one before, and these nodes are ``endless``; they have no path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import empty_ids
from ..hierarchy import Hierarchy
from ..plans.layout import dealt
from ..plans.materialize import RoundWriter
from .common import question_ids as _ids, union_all
from .index import peeled

LEVEL_SCHEMA = "node bigint, up bigint"


@dataclass
class JumpTable:
    """``levels[k]``: ``(node, up)``, where ``up`` is 2^k steps above ``node``; ``endless``: nodes that lead into a cycle.

    ``layers``: ``(node, up)`` of nodes that are on no level, with their parents; parents are in a later layer or on a level."""

    levels: list[DataFrame]
    endless: DataFrame | None
    writer: RoundWriter
    rounds: int = field(default=0)  # joins of the last search
    layers: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        self.writer.release()


def build_jumps(parents: DataFrame, node: str = "node", up: str = "up") -> JumpTable:
    """The jump table of ``(node, up)``: one parent per node at most; a top node has no row (or a null parent)."""
    writer = RoundWriter(parents, "jumps")
    first = parents.select(F.col(node).cast("bigint").alias("node"), F.col(up).cast("bigint").alias("up")).where("up IS NOT NULL")

    def stored(df: DataFrame) -> tuple[DataFrame, int]:
        k = len(levels)
        seen = Observation(f"jumps{k}")
        level = writer.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"level-{k}")
        return level, seen.get["rows"]

    levels: list[DataFrame] = []
    level, count = stored(first)
    endless = None
    while count:
        levels.append(level)
        above = level.select(F.col("node").alias("up"), F.col("up").alias("_far"))
        level, more = stored(level.join(above, "up").select("node", F.col("_far").alias("up")))
        if more == count:  # an acyclic node with 2^(k+1) ancestors has an ancestor with between 2^k and that many
            endless = level.select("node")
            break
        count = more
    return JumpTable(levels, endless, writer)


def tree_jumps(h: Hierarchy) -> JumpTable:
    """The jump table of a hierarchy's first parents, kept on the hierarchy."""
    def make() -> JumpTable:
        writer = RoundWriter(h.spark, "jump-layers")
        core, layers = peeled(h.first_parent().select(F.col("src").alias("id"), F.col("parent").alias("top")), writer)
        jumps = build_jumps(core, "id", "top")
        jumps.layers = [x.select(F.col("id").alias("node"), F.col("top").alias("up")) for x in layers]
        jumps.writer.paths.update(writer.paths)
        if jumps.endless is not None:
            for layer in reversed(jumps.layers):
                over = jumps.endless.withColumnRenamed("node", "up")
                jumps.endless = jumps.endless.unionByName(layer.join(over, "up", "left_semi").select("node"))
        return jumps

    return h.derived("jumps", make)


def path_to_root(jumps: JumpTable, ids: DataFrame, root: int, id_col: str = "vid") -> DataFrame:
    """``(vid, path)``: root-first path ending in ``vid``; ``[]`` for the root, unknown ids, and chains that do not reach it."""
    writer = RoundWriter(ids, "jump-path")
    q = writer.write(_ids(ids, id_col), "asked")
    # asked nodes of a layer ask for their parent, which many of them share
    steps, asked = [], q
    for n, layer in enumerate(jumps.layers):
        step = asked.join(layer.withColumnRenamed("node", "vid"), "vid", "left").select("vid", F.coalesce("up", "vid").alias("next"))
        steps.append(writer.write(step, f"step-{n}"))
        asked = writer.write(steps[-1].select(F.col("next").alias("vid")).distinct(), f"asked-{n}")
    walkers = asked.where(F.col("vid") != F.lit(root))
    if jumps.endless is not None:
        walkers = walkers.join(jumps.endless.withColumnRenamed("node", "vid"), "vid", "left_anti")
    zero = F.lit(0).cast("bigint")
    found = writer.write(walkers.select("vid", F.col("vid").alias("node"), zero.alias("dist")), "from")
    tags, schema = ["from"], found.schema
    jumps.rounds = 0
    for k in reversed(range(len(jumps.levels))):
        step = found.join(jumps.levels[k], "node").select("vid", F.col("up").alias("node"), (F.col("dist") + (1 << k)).alias("dist"))
        writer.write(step, f"by-{1 << k}")
        tags.append(f"by-{1 << k}")
        found = writer.read(tags, schema)
        jumps.rounds += 1
    # a path is as long as the tree is deep
    lists = dealt(found, "vid").groupBy("vid").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("dist")).alias("d"), F.col("node").alias("n")))).alias("_l"),
        F.max(F.col("node") == F.lit(root)).alias("_there"))
    paths = lists.where("_there").select("vid", F.transform("_l", lambda x: x["n"]).alias("path"))
    top = asked.where(F.col("vid") == F.lit(root)).select("vid", F.array("vid").alias("path"))
    paths = paths.unionByName(top)
    for n, step in reversed(list(enumerate(steps))):
        over = writer.write(paths, f"paths-{n}").withColumnRenamed("vid", "next")
        here = F.when(F.col("vid") == F.col("next"), F.col("path")).otherwise(F.concat("path", F.array("vid")))
        paths = step.join(over, "next").select("vid", here.alias("path"))
    out = q.join(paths, "vid", "left")
    path = F.when(F.col("vid") == F.lit(root), empty_ids()).otherwise(F.coalesce("path", empty_ids()))
    return out.select("vid", path.alias("path"))


def ancestor_sums(jumps: JumpTable, values: DataFrame, value: str, tag: str = "up") -> DataFrame:
    """``(node, value)``: the sum of ``value`` over a node and all its ancestors, for all nodes of ``values``."""
    writer = jumps.writer
    state = writer.write(values.select("node", F.col(value).alias("s")), f"{tag}-start")
    for k, level in enumerate(jumps.levels):
        far = level.join(state.select(F.col("node").alias("up"), F.col("s").alias("_more")), "up").select("node", "_more")
        state = writer.write(state.join(far, "node", "left").select("node", (F.col("s") + F.coalesce("_more", F.lit(0))).alias("s")), f"{tag}-{k}")
    return state.withColumnRenamed("s", value)


def descendant_sums(jumps: JumpTable, values: DataFrame, value: str, tag: str = "down") -> DataFrame:
    """``(node, value)``: the sum of ``value`` over a node and all its descendants, for all nodes of ``values``."""
    writer = jumps.writer
    state = writer.write(values.select("node", F.col(value).alias("s")), f"{tag}-start")
    for k, level in enumerate(jumps.levels):
        below = level.join(state, "node").groupBy(F.col("up").alias("node")).agg(F.sum("s").alias("_more"))
        state = writer.write(state.join(below, "node", "left").select("node", (F.col("s") + F.coalesce("_more", F.lit(0))).alias("s")), f"{tag}-{k}")
    return state.withColumnRenamed("s", value)


#: In the sums of :func:`depths`, what the root adds beside the steps.
HIT = 1 << 48


def depths(jumps: JumpTable, h: Hierarchy) -> DataFrame:
    """``(node, depth)`` of every node that reaches the root. The jump table is that of :func:`tree_jumps`."""
    root = h.spark.range(1).select(F.lit(h.root).cast("bigint").alias("node"), F.lit(HIT).cast("bigint").alias("depth"))
    nodes = root
    if jumps.levels:
        steps = jumps.levels[0].select("node", F.lit(1).cast("bigint").alias("depth"))
        if jumps.endless is not None:
            steps = steps.join(jumps.endless, "node", "left_anti")
        nodes = steps.unionByName(root)
    # steps and the root's mark in one sum
    far = ancestor_sums(jumps, nodes, "depth", "depth").where(F.col("depth") >= HIT)
    parts = [far.select("node", (F.col("depth") - HIT).alias("depth"))]
    for n, layer in reversed(list(enumerate(jumps.layers))):
        over = union_all(parts).select(F.col("node").alias("up"), "depth")
        below = layer.join(over, "up").select("node", (F.col("depth") + 1).alias("depth"))
        parts.append(jumps.writer.write(below, f"depth-layer-{n}"))
    return union_all(parts)

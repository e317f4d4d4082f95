"""What a path index leaves out, and why.

Every node that an edge names is either indexed or left out for one reason:

* ``past level``: it is below the root, but deeper than the index goes;
* ``orphan``: it is not below the root, and above it is a node without parents other than the root;
* ``cycle``: all ways up from it run in circles.

Nodes are reached downwards in rounds, first from the root, then from all other nodes
without parents; what neither reaches hangs on cycles alone. A round is one join of the newly
reached nodes with the edges, which are laid out by parent once, and is written to the shared folder; nodes
reached before are dropped, so a cycle is gone through once at most. Edges out of the root are not followed, as in the index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..hierarchy import Hierarchy
from ..plans.layout import keyed
from ..plans.materialize import RoundWriter
from ..plans.skew import SALT, salt_one


def reached(h: Hierarchy, seeds: DataFrame, name: str = "reached", avoid: DataFrame | None = None) -> DataFrame:
    """``(id, depth)``: the seeds ``(id)`` at depth 0 and every node below them at the least depth, without those of ``avoid``."""
    writer = RoundWriter(h.spark, name)
    hot = h.hot_parents()
    edges = h.salted_edges().where(F.col("src") != F.lit(h.root)).select(F.col("src").alias("_c"), F.col("dst").alias("_p"), F.col(SALT).alias("_s"))
    start = seeds.select(F.col("id").cast("bigint").alias("id"), F.lit(0).alias("depth")).distinct()
    if avoid is not None:
        edges = edges.join(avoid.select(F.col("id").alias("_c")), "_c", "left_anti").select("_c", "_p", "_s")
        start = start.join(avoid.select("id"), "id", "left_anti")
    edges = keyed(edges, "_p", "_s")
    try:
        frontier = writer.write(start, "depth-0")
        schema, tags, depth = frontier.schema, ["depth-0"], 0
        while True:
            depth += 1
            asked = salt_one(frontier.select("id"), "id", hot)
            below = asked.join(edges, (F.col("id") == F.col("_p")) & (F.col(SALT) == F.col("_s"))).select(F.col("_c").alias("id")).distinct()
            below = below.join(writer.read(tags, schema).select("id"), "id", "left_anti")
            seen = Observation(f"{name}{depth}")
            rows = below.select("id", F.lit(depth).alias("depth")).observe(seen, F.count(F.lit(1)).alias("rows"))
            frontier = writer.write(rows, f"depth-{depth}")
            if not seen.get["rows"]:
                return writer.read(tags, schema)
            tags.append(f"depth-{depth}")
    finally:
        edges.unpersist()


def index_rejects(h: Hierarchy, max_level: int = -1) -> DataFrame:
    """``(id, reason)`` of every node of the edges that an index of ``max_level`` levels (-1: all) has no row for."""
    # the edges may be the end of a long plan, and every step below reads them
    h = Hierarchy(RoundWriter(h.spark, "reject-edges").write(h.edges.select("src", "dst"), "edges"), None, h.root, h.skew)
    above = h.edges.select(F.col("dst").alias("id"))
    nodes = h.edges.select(F.col("src").alias("id")).unionByName(above).distinct()
    root = h.spark.range(1).select(F.lit(h.root).cast("bigint").alias("id"))
    inside = reached(h, root, "below-root")
    children = h.edges.select(F.col("src").alias("id"))
    tops = above.where(F.col("id") != F.lit(h.root)).distinct().join(children, "id", "left_anti")
    orphans = reached(h, tops, "below-tops", avoid=inside)
    out = nodes.join(inside, "id", "left_anti").join(
        orphans.select("id", F.lit("orphan").alias("_r")), "id", "left").select("id", F.coalesce("_r", F.lit("cycle")).alias("reason"))
    if max_level < 0:
        return out
    return out.unionByName(inside.where(F.col("depth") > max_level).select("id", F.lit("past level").alias("reason")))

"""Graph-pattern (motif) searches, written as joins.

A motif binds an edge only when both of its ends are vertices, so the pattern
``(a)-[]->(b)`` is the edge table semi-joined with the vertex table on both
ends. Everything else is the same join machinery as the direct variant, run on
those edges:

* ``edge_motif``                      ``(src)-[]->(dst)`` with the vertex rows of both ends
* ``path_to_root`` / ``is_subtree``   upward walk over motif edges
* ``children``                        ``(child)-[]->(vid)``
* ``siblings``                        ``(vid)-[]->(a); (sibling)-[]->(a)``, every shared parent,
                                      so a sibling repeats once per shared parent
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..hierarchy import Hierarchy
from ..plans.materialize import RoundWriter
from . import direct
from .common import question_ids as _ids
from .direct import children_of


def motif_edges(h: Hierarchy) -> DataFrame:
    """Edges whose two ends are both vertices."""
    v = h.require_vertices().select(F.col("id"))
    e = h.edges.join(v.withColumnRenamed("id", "src"), "src", "left_semi")
    return e.join(v.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst", "relationship")


def motif_hierarchy(h: Hierarchy) -> Hierarchy:
    """The hierarchy of motif edges, kept on ``h``: the edges are written once and read by every search.

    The hot-parent table of all edges bounds the motif edges' counts too; it is shared."""
    def make() -> Hierarchy:
        stored = RoundWriter(h.spark, "motif-edges").write(motif_edges(h), "edges")
        return Hierarchy(stored, h.vertices, h.root, h.skew, h.hot_parent_rows())

    return h.derived("motif", make)


def edge_motif(h: Hierarchy) -> DataFrame:
    """``(src struct, dst struct, relationship)``: ``(src)-[]->(dst)`` with full vertex rows."""
    v = h.require_vertices()
    cols = [F.col(c) for c in v.columns]
    vs = v.select(F.col("id").alias("_sid"), F.struct(*cols).alias("src"))
    vd = v.select(F.col("id").alias("_did"), F.struct(*cols).alias("dst_v"))
    e = motif_hierarchy(h).edges.select(F.col("src").alias("_es"), F.col("dst").alias("_ed"), "relationship")
    j = e.join(vs, F.col("_es") == F.col("_sid")).join(vd, F.col("_ed") == F.col("_did"))
    return j.select(F.col("src"), F.col("dst_v").alias("dst"), "relationship")


def path_to_root(h: Hierarchy, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """As :func:`direct.path_to_root`, every hop needing both ends to be vertices."""
    return direct.path_to_root(motif_hierarchy(h), ids, id_col)


def is_subtree(h: Hierarchy, pairs: DataFrame, target_col: str = "target", source_col: str = "source") -> DataFrame:
    return direct.is_subtree(motif_hierarchy(h), pairs, target_col, source_col)


def children(h: Hierarchy, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    return direct.children(motif_hierarchy(h), ids, id_col)


def siblings(h: Hierarchy, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """``(vid, sibling)`` across all parents of ``vid``; no de-duplication."""
    m = motif_hierarchy(h)
    q = _ids(ids, id_col)
    ups = m.edges.select(F.col("src").alias("vid"), F.col("dst").alias("parent")).join(q, "vid", "left_semi")
    out = children_of(m, ups, key="parent").where(F.col("child") != F.col("vid"))
    return out.select("vid", F.col("child").alias("sibling"))

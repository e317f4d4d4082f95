"""Searches answered from the parent edges alone (no index).

All functions take a DataFrame of question ids and answer every distinct id at
once: ``vid`` for the one-id searches, ``(target, source)`` for is-subtree.

* single-answer walks follow the smallest parent of each node (a node with
  several parents is walked through ``min(dst)``),
* ``children`` / ``siblings`` look up parents' children through a join salted on
  hot parents, so a parent with millions of children is read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..hierarchy import Hierarchy
from ..plans.skew import SALT, salt_one
from .common import question_ids as _ids
from .index import build_index
from .indexed import path_to_root as _indexed_path
from .walk import walk_is_subtree, walk_paths


def path_to_root(h: Hierarchy, ids: DataFrame, id_col: str = "vid", method: str = "walk") -> DataFrame:
    """``(vid, path array<bigint>)``: root-first path ending in ``vid``, ``[]`` when there is none.

    ``method='walk'`` hops up one parent per round from the asked ids only
    (rounds = depth; best for a few ids). ``method='doubling'`` jumps pointers
    over the first-parent table of the whole tree (rounds = log2 depth; best
    when most nodes are asked). Both follow the smallest parent of each node.
    """
    if method == "walk":
        return walk_paths(h.walk_table(), ids, h.root, id_col, conf=h.conf())
    if method != "doubling":
        raise ValueError(f"method must be 'walk' or 'doubling', got {method!r}")
    first = h.first_parent().select(F.col("src"), F.col("parent").alias("dst"))
    chains = build_index(Hierarchy(first, root=h.root, skew=h.skew), -1, method="doubling")
    # one parent per node: one chain per node, nothing to choose between
    return _indexed_path(chains, ids, id_col, unique=True)


def is_subtree(h: Hierarchy, pairs: DataFrame, target_col: str = "target", source_col: str = "source",
               depths: DataFrame | None = None) -> DataFrame:
    """``(target, source, is_subtree)``: is ``target`` in the subtree of ``source``.

    With ``depths`` (``node, depth``, see :func:`arbor.operators.jump.depths`) a walk ends at the depth of its highest source."""
    return walk_is_subtree(h.walk_table(), pairs, h.root, target_col, source_col, conf=h.conf(), depths=depths)


def children_of(h: Hierarchy, parents: DataFrame, key: str = "vid") -> DataFrame:
    """``(vid, child)`` for every edge whose parent is a ``vid`` of ``parents`` (salted on hot parents)."""
    hot = h.hot_parents()
    if hot is None:
        e = h.edges.select(F.col("src").alias("child"), F.col("dst").alias("_p"))
        return parents.join(e, F.col(key) == F.col("_p")).drop("_p")
    q = salt_one(parents, key, hot)
    e = h.salted_edges().select(F.col("src").alias("child"), F.col("dst").alias("_p"), F.col(SALT).alias("_s"))
    j = q.join(e, (F.col(key) == F.col("_p")) & (F.col(SALT) == F.col("_s")))
    return j.drop("_p", "_s", SALT)


def children(h: Hierarchy, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """``(vid, child)``: every child of each asked id; no rows for leaves and unknown ids."""
    return children_of(h, _ids(ids, id_col)).select("vid", "child")


def siblings(h: Hierarchy, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """``(vid, sibling)``: the other children of the id's first (smallest) parent."""
    q = _ids(ids, id_col)
    fp = h.first_parent().select(F.col("src").alias("vid"), F.col("parent"))
    with_parent = q.join(fp, "vid")
    out = children_of(h, with_parent, key="parent").where(F.col("child") != F.col("vid"))
    return out.select("vid", F.col("child").alias("sibling"))

"""JSON documents of search answers.

Nodes are ``{"ID": id, "Name": name}`` where the name is the packed name
string with commas shown as spaces (``",all,root,"`` -> ``" all root "``) and
``""`` when the id has no name. Names come from one left join with the vertex
table per document, never from per-id lookups; the JSON text is made by
``to_json``.

Children, sibling and nested documents are lists that can grow with the data,
so they are rows, in one shape at every size: ``(vid, level, parent, id, json)``.
Each asked id has a head row (level 0, no parent, its own node) and one row per
list entry (level 1, or deeper in a nested document) with the entry's parent and
its node. No list is gathered anywhere. Path documents are bounded by the depth
and are one row ``(vid, json)``, root first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import node
from ..plans.materialize import RoundWriter
from . import indexed
from .common import question_ids as _ids, union_all
from .index import StoredIndex


def _named(df: DataFrame, id_col: str, vertices: DataFrame, out: str = "_node") -> DataFrame:
    v = vertices.select(F.col("id").alias("_vid"), F.col("name").alias("_vname"))
    j = df.join(v, F.col(id_col) == F.col("_vid"), "left")
    return j.withColumn(out, node(F.col(id_col), F.col("_vname"))).drop("_vid", "_vname")


def _empty_nodes():
    return F.array().cast("array<struct<ID:bigint,Name:string>>")


def _rows(df: DataFrame, level: int, parent: str | None, entry: str) -> DataFrame:
    up = F.col(parent) if parent else F.lit(None)
    return df.select("vid", F.lit(level).alias("level"), up.cast("bigint").alias("parent"), F.col(entry).alias("id"))


def _document(parts: list[DataFrame], vertices: DataFrame) -> DataFrame:
    """Head and entry rows with their nodes: one join with the vertex table for all of them."""
    named = _named(union_all(parts), "id", vertices)
    return named.select("vid", "level", "parent", "id", F.to_json("_node").alias("json"))


def children_doc(index: DataFrame | StoredIndex, vertices: DataFrame, ids: DataFrame, id_col: str = "vid",
                 hot: DataFrame | None = None) -> DataFrame:
    """``(vid, level, parent, id, json)``: the node of ``vid`` and one row per child in the index."""
    q = _ids(ids, id_col)
    kids = indexed.children(index, q, hot=hot)
    return _document([_rows(q, 0, None, "vid"), _rows(kids, 1, "vid", "child")], vertices)


def path_doc(index: DataFrame | StoredIndex, vertices: DataFrame, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """``[{"ID", "Name"}, ...]`` root-first down to ``vid``; ``[]`` for the root and unindexed ids."""
    paths = indexed.path_to_root(index, ids, id_col)
    # one pass over the paths: an empty path keeps its id as one row with no step
    steps = paths.select("vid", F.posexplode_outer("path").alias("pos", "step"))
    named = _named(steps, "step", vertices)
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "_node"))
    lists = named.groupBy("vid").agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    nodes = F.transform("_l", lambda x: x["_node"])
    return lists.select("vid", F.to_json(F.coalesce(nodes, _empty_nodes())).alias("json"))


def sibling_doc(index: DataFrame | StoredIndex, vertices: DataFrame, ids: DataFrame, id_col: str = "vid",
                hot: DataFrame | None = None) -> DataFrame:
    """``(vid, level, parent, id, json)``: the node of ``vid`` and one row per sibling in the index."""
    q = _ids(ids, id_col)
    sib = indexed.siblings_with_parent(index, q, hot=hot)
    return _document([_rows(q, 0, None, "vid"), _rows(sib, 1, "parent", "sibling")], vertices)


def nested_doc(index: DataFrame | StoredIndex, vertices: DataFrame, ids: DataFrame, id_col: str = "vid",
               depth: int = 2, hot: DataFrame | None = None) -> DataFrame:
    """``(vid, level, parent, id, json)``: the nodes within ``depth`` levels below ``vid``, one row each.

    A level asks the index once for the children of the distinct nodes of the
    level above and is stored, so the plan grows by one lookup per level.
    """
    if depth < 1:
        raise ValueError("depth must be at least 1")
    q = _ids(ids, id_col)
    writer = RoundWriter(q, "nested")
    parts = [_rows(q, 0, None, "vid")]
    above = q.select("vid", F.col("vid").alias("id"))
    for level in range(1, depth + 1):
        kids = indexed.children(index, above.select("id").distinct(), id_col="id", hot=hot)
        rows = above.join(kids.withColumnRenamed("vid", "id"), "id").select("vid", F.col("id").alias("parent"), "child").distinct()
        rows = writer.write(rows, f"level-{level}")
        parts.append(_rows(rows, level, "parent", "child"))
        above = rows.select("vid", F.col("child").alias("id")).distinct()
    return _document(parts, vertices)

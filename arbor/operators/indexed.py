"""Searches answered from the path-to-root index.

``index`` is a table as :func:`arbor.operators.index.build_index` returns or
:func:`read_index` reads, ``(id, path, depth, parent, ancestors)``, or a
:class:`~arbor.operators.index.StoredIndex`. Every search joins the question ids
with the index on an equality key (id, or parent id): a broadcast hash join when
the questions are few, a salted shuffle join when both sides are large. Over a
stored index a few asked ids or parents are pushed to the scan, and so are the path
ranges of a few subtrees; questions are looked at for that only where they are known
to be small, so no search runs its questions twice.

Depth-limited indexes answer only what they hold: a node below the limit has
no path, and a node at the limit has no children in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import PATH_SEP, child_path, empty_ids
from ..plans.materialize import RoundWriter
from ..plans.skew import SALT, salt_many, salt_one
from .common import question_ids as _ids
from .index import StoredIndex, few_ids

#: Subtrees whose path ranges are pushed to the scan; more of them read the whole index, with the same answer.
MAX_RANGES = 64


def table_of(index: DataFrame | StoredIndex) -> DataFrame:
    """The whole index as one table."""
    return index.by_path if isinstance(index, StoredIndex) else index


def _asked(index: DataFrame | StoredIndex, questions: DataFrame, column: str = "vid") -> tuple[DataFrame, list[int] | None]:
    """The questions and, over a stored index, the values of ``column`` if they are few."""
    return index.looked(questions, column) if isinstance(index, StoredIndex) else (questions, None)


def _rows(index: DataFrame | StoredIndex, copy: str, few: list[int] | None) -> DataFrame:
    return index.rows_of(copy, few) if isinstance(index, StoredIndex) else index


def _below(index: DataFrame | StoredIndex, sources: DataFrame, few: list[int] | None) -> DataFrame:
    """Index rows that hold all descendants of the sources: for a few sources, their path ranges only."""
    if not isinstance(index, StoredIndex) or few is None:
        return table_of(index)
    mine = _rows(index, "id", few).join(sources, F.col("id") == F.col("vid"), "left_semi")
    found = mine.select(child_path(F.col("path"), F.col("id")).alias("low")).distinct().take(MAX_RANGES + 1)
    if len(found) > MAX_RANGES:
        return index.by_path
    inside = F.lit(False)
    for r in found:  # every path below starts with ``low``, which ends in the separator
        inside = inside | ((F.col("path") >= r["low"]) & (F.col("path") < r["low"][:-1] + chr(ord(PATH_SEP) + 1)))
    return index.by_path.where(inside)


def path_to_root(index: DataFrame | StoredIndex, ids: DataFrame, id_col: str = "vid", unique: bool = False) -> DataFrame:
    """``(vid, path)``: ancestors root-first then ``vid``; ``[]`` for the root, ids not indexed.

    A node indexed under several paths answers with its smallest path. ``unique=True`` states that
    the index has one row per id (e.g. first-parent chains), which skips picking among paths.
    """
    q, few = _asked(index, _ids(ids, id_col))
    idx = _rows(index, "id", few).select(F.col("id").alias("vid"), "path", "ancestors")
    mine = idx.join(q, "vid", "left_semi")
    if unique:
        best = mine.select("vid", F.struct("path", "ancestors").alias("_b"))
    else:
        best = mine.groupBy("vid").agg(F.min(F.struct("path", "ancestors")).alias("_b"))
    out = q.join(best, "vid", "left")
    anc = F.col("_b.ancestors")
    path = F.when(F.col("_b").isNull() | (F.size(anc) == 0), empty_ids()).otherwise(
        F.concat(anc, F.array(F.col("vid"))))
    return out.select("vid", path.alias("path"))


def is_subtree(index: DataFrame | StoredIndex, pairs: DataFrame, target_col: str = "target", source_col: str = "source") -> DataFrame:
    """``(target, source, is_subtree)``: equal ids, or ``source`` on any indexed path of ``target``.

    A target missing from the index gives false.
    """
    q = pairs.select(F.col(target_col).cast("bigint").alias("target"),
                     F.col(source_col).cast("bigint").alias("source")).dropna().distinct()
    q, few = _asked(index, q, "target")
    idx = _rows(index, "id", few).select(F.col("id").alias("target"), "ancestors")
    # inner join first: with a few pairs the pairs are broadcast into the index scan (a left join could
    # not broadcast its left side and would shuffle the whole index); pairs without an indexed target
    # come back through the left join with this result, which is no larger than the pairs
    hits = q.join(idx, "target").groupBy("target", "source").agg(
        F.max(F.array_contains(F.col("ancestors"), F.col("source"))).alias("_any"))
    out = q.join(hits, ["target", "source"], "left")
    same = F.col("target") == F.col("source")
    return out.select("target", "source", (same | F.coalesce(F.col("_any"), F.lit(False))).alias("is_subtree"))


def subtree_members(index: DataFrame | StoredIndex, sources: DataFrame, id_col: str = "vid") -> DataFrame:
    """``(vid, member)``: every indexed node below ``vid``, and ``vid`` itself when indexed.

    Each index row is expanded to its ancestors and equi-joined with the
    sources (a generator feeding the join inside one codegen stage, so the
    ancestor pairs are never stored). Over a stored index, the rows of a few
    sources are path ranges that Parquet statistics skip to. A source near the
    root is a hot key; the join's probe side is the expanded index, which AQE's
    skew-join split cuts into pieces.
    """
    q, few = _asked(index, _ids(sources, id_col))
    below = _below(index, q, few).select(F.col("id").alias("member"), F.explode("ancestors").alias("vid"))
    below = below.join(q, "vid", "left_semi")
    itself = _rows(index, "id", few).select(F.col("id").alias("vid"), F.col("id").alias("member")).join(q, "vid", "left_semi")
    return below.unionByName(itself).distinct()


def children(index: DataFrame | StoredIndex, ids: DataFrame, id_col: str = "vid", hot: DataFrame | None = None) -> DataFrame:
    """``(vid, child)``: index rows one level below the smallest indexed path of ``vid``, each child once."""
    q, few = _asked(index, _ids(ids, id_col))
    mine = _rows(index, "id", few).select(F.col("id").alias("vid"), "path").join(q, "vid", "left_semi")
    mine = mine.groupBy("vid").agg(F.min("path").alias("path"))
    want = mine.select("vid", child_path(F.col("path"), F.col("vid")).alias("_cpath"))
    return _join_children(_rows(index, "parent", few), want, hot, one_path=True).select("vid", "child")


def siblings(index: DataFrame | StoredIndex, ids: DataFrame, id_col: str = "vid", hot: DataFrame | None = None) -> DataFrame:
    """``(vid, sibling)``: other ids stored under a path of ``vid``, each once (the root has none)."""
    return siblings_with_parent(index, ids, id_col, hot).select("vid", "sibling")


def siblings_with_parent(index: DataFrame | StoredIndex, ids: DataFrame, id_col: str = "vid",
                         hot: DataFrame | None = None) -> DataFrame:
    """``(vid, parent, sibling)``: as :func:`siblings`, with the smallest parent that the two share."""
    q, few = _asked(index, _ids(ids, id_col))
    mine = _rows(index, "id", few).select(F.col("id").alias("vid"), "path", "parent").join(q, "vid", "left_semi")
    want = mine.where(F.col("parent").isNotNull()).select(
        "vid", F.col("parent").alias("_owner"), F.col("path").alias("_cpath"))
    owners = None
    if few is not None:  # a few ids have a few parents: these are pushed to the scan as well
        want = RoundWriter(want, "owners").write(want, "rows")
        owners = few_ids(want, "_owner")
    out = _join_children(_rows(index, "parent", owners), want, hot, owner="_owner").where(F.col("child") != F.col("vid"))
    return out.groupBy("vid", F.col("child").alias("sibling")).agg(F.min("_owner").alias("parent")).select("vid", "parent", "sibling")


def sibling_classes(index: DataFrame | StoredIndex, hot: DataFrame | None = None) -> DataFrame:
    """``(parent, path, member, class_size)``: every indexed node below the root with the path that it shares with its siblings.

    Members of one class are each other's siblings: one row per index row stands for all pairs. Sizes are partial
    counts, handed back to the members in a join that is salted on hot parents."""
    rows = table_of(index).where(F.col("parent").isNotNull()).select("parent", "path", F.col("id").alias("member"))
    sizes = rows.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("class_size"))
    if hot is None:
        return rows.join(sizes, ["parent", "path"]).select("parent", "path", "member", "class_size")
    many, one = salt_many(rows, "parent", "member", hot), salt_one(sizes, "parent", hot)
    return many.join(one, ["parent", "path", SALT]).select("parent", "path", "member", "class_size")


def siblings_in(classes: DataFrame, ids: DataFrame, id_col: str = "vid", hot: DataFrame | None = None) -> DataFrame:
    """``(vid, sibling)`` of the asked ids, out of sibling classes: only the classes of asked ids are expanded."""
    q = _ids(ids, id_col)
    mine = classes.join(q, F.col("member") == F.col("vid")).select("vid", "parent", "path")
    members = classes.select("parent", "path", F.col("member").alias("sibling"))
    if hot is None:
        met = mine.join(members, ["parent", "path"])
    else:
        met = salt_one(mine, "parent", hot).join(salt_many(members, "parent", "sibling", hot), ["parent", "path", SALT])
    return met.where(F.col("sibling") != F.col("vid")).select("vid", "sibling").distinct()


def _join_children(index: DataFrame, want: DataFrame, hot: DataFrame | None, owner: str = "vid", one_path: bool = False) -> DataFrame:
    """Rows of ``index`` whose ``(parent, path)`` equals ``(want[owner], want._cpath)``.

    ``one_path`` states that ``want`` has one row per owner. Rows are then shuffled by their parent alone, and paths
    compared after that: ``want`` stays where its grouping has put it, and rows of one parent, whose paths are much
    alike, travel side by side. Two bounds say "equal" here, as an equality would become a key of the shuffle."""
    rows = index.select(F.col("id").alias("child"), F.col("parent").alias("_p"), F.col("path").alias("_path"))
    if one_path:
        same = (F.col("_path") >= F.col("_cpath")) & (F.col("_path") <= F.col("_cpath"))
    else:
        same = F.col("_cpath") == F.col("_path")
    if hot is None:
        return want.join(rows, (F.col(owner) == F.col("_p")) & same)
    w = salt_one(want, owner, hot)
    r = salt_many(rows, "_p", "child", hot).withColumnRenamed(SALT, "_rs")
    return w.join(r, (F.col(owner) == F.col("_p")) & (F.col(SALT) == F.col("_rs")) & same)


def path_names(index: DataFrame | StoredIndex, vertices: DataFrame) -> DataFrame:
    """``(vid, pos, ancestor, name)``: every ancestor on every indexed path, root first (pos 0), with its
    packed name (``""`` when it has none). One left join with the vertex table for all rows."""
    steps = table_of(index).select(F.col("id").alias("vid"), F.posexplode("ancestors").alias("pos", "ancestor"))
    v = vertices.select(F.col("id").alias("ancestor"), F.col("name").alias("_n"))
    out = steps.join(v, "ancestor", "left")
    return out.select("vid", F.col("pos").cast("int").alias("pos"), "ancestor",
                      F.coalesce(F.col("_n"), F.lit("")).alias("name"))

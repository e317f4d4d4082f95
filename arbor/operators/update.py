"""Apply a set of edge changes to a path index without building it anew.

Only nodes at or below a changed child can have other paths than before: a path that runs
over a changed edge runs through its child. These *touched* nodes are reached downwards in
rounds, over the old and the new edges. Their rows are dropped, and built again from the rows
of their untouched parents, level by level; all other rows stay as they are. So the work
follows what lies below the changes, not the index.

Over a :class:`~arbor.operators.index.StoredIndex`, files without a touched row are kept: the
others' remaining rows and the new ones are written beside them, and the new index is a
list of files of each copy. The old index stays readable.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import child_path
from ..hierarchy import Hierarchy
from ..plans.materialize import RoundWriter
from ..plans.skew import SALT, salt_one
from .common import union_all
from .index import INDEX_SCHEMA, StoredIndex
from .rejects import reached


def changed_hierarchy(h: Hierarchy, added: DataFrame, removed: DataFrame) -> Hierarchy:
    """The hierarchy after the change: its edges without ``removed (src, dst)``, and with ``added (src, dst)``."""
    gone = removed.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst")).distinct()
    new = added.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst")).where("src <> dst").distinct()
    label = h.edges.select("relationship").schema[0]
    stay = h.edges.join(gone, ["src", "dst"], "left_anti")
    more = new.join(stay.select("src", "dst"), ["src", "dst"], "left_anti").withColumn("relationship", F.lit("parent").cast(label.dataType))
    return Hierarchy(stay.unionByName(more), h.vertices, h.root, h.skew)


def touched_nodes(before: Hierarchy, after: Hierarchy, added: DataFrame, removed: DataFrame) -> DataFrame:
    """``(id)``: every child of a changed edge and all nodes below it, before or after the change."""
    both = Hierarchy(before.edges.select("src", "dst").unionByName(after.edges.select("src", "dst")).distinct(), None, before.root, before.skew)
    children = added.select(F.col("src").alias("id")).unionByName(removed.select(F.col("src").alias("id")))
    return reached(both, children.where(F.col("id") != F.lit(before.root)), "touched").select("id")


def rebuilt_rows(stay: DataFrame, after: Hierarchy, touched: DataFrame, max_level: int = -1) -> DataFrame:
    """Index rows of the touched nodes: from the rows of their untouched parents downwards."""
    writer = RoundWriter(after.spark, "index-below")
    hot = after.hot_parents()
    edges = after.salted_edges().join(touched.withColumnRenamed("id", "src"), "src", "left_semi")
    edges = writer.write(edges.select(F.col("src").alias("_c"), F.col("dst").alias("_p"), F.col(SALT).alias("_s")), "edges")
    parents = edges.select(F.col("_p").alias("id")).distinct()
    frontier, tags, level = stay.join(parents, "id", "left_semi"), [], 0
    while True:
        level += 1
        f = salt_one(frontier.select("id", "path", "depth", "ancestors"), "id", hot)
        upto = F.concat(F.col("ancestors"), F.array(F.col("id")))
        new = f.join(edges, (F.col("id") == F.col("_p")) & (F.col(SALT) == F.col("_s"))).where(
            (F.col("_c") != F.lit(after.root)) & ~F.array_contains(upto, F.col("_c"))).select(
            F.col("_c").alias("id"), child_path(F.col("path"), F.col("id")).alias("path"), (F.col("depth") + 1).cast("int").alias("depth"),
            F.col("id").alias("parent"), upto.alias("ancestors"))
        if max_level >= 0:
            new = new.where(F.col("depth") <= max_level)
        seen = Observation(f"below{level}")
        frontier = writer.write(new.observe(seen, F.count(F.lit(1)).alias("rows")), f"level-{level}")
        tags.append(f"level-{level}")
        if not seen.get["rows"]:
            return writer.read(tags, INDEX_SCHEMA)


def update_index(index: DataFrame, before: Hierarchy, added: DataFrame, removed: DataFrame, max_level: int = -1) -> DataFrame:
    """The index after the edge change, equal to one built from the changed edges. ``index`` has ``max_level`` levels."""
    after = changed_hierarchy(before, added, removed)
    touched = touched_nodes(before, after, added, removed)
    stay = index.select(*INDEX_SCHEMA.names).join(touched, "id", "left_anti")
    return stay.unionByName(rebuilt_rows(stay, after, touched, max_level))


def update_stored(index: StoredIndex, before: Hierarchy, added: DataFrame, removed: DataFrame, max_level: int = -1) -> StoredIndex:
    """As :func:`update_index` for a stored index: files that hold no touched row are kept as they are."""
    after = changed_hierarchy(before, added, removed)
    touched = touched_nodes(before, after, added, removed)
    stay = index.lookup("id").join(touched, "id", "left_anti")
    new = rebuilt_rows(stay, after, touched, max_level)
    version, files = uuid.uuid4().hex[:12], {}
    for copy in StoredIndex.KEYS:
        names = StoredIndex.LOOKUPS.get(copy, INDEX_SCHEMA).names
        rows = index.copy(copy)
        held = rows.withColumn("_file", F.input_file_name()).join(touched, "id", "left_semi")
        hit = [r[0] for r in held.select("_file").distinct().collect()]  # a name for each file
        left = [f for f in rows.inputFiles() if f not in set(hit)]
        parts = [new.select(*names)]
        if hit:
            parts.append(index.read(copy, *hit).join(touched, "id", "left_anti").select(*names))
        folder = f"{index.path}/{copy}-{version}"
        index.write_copy(union_all(parts), copy, folder)
        files[copy] = left + index.read(copy, folder).inputFiles()
    return StoredIndex(index.spark, index.path, files)

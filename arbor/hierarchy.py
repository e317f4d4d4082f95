"""The prepared hierarchy every operator works on.

``Hierarchy`` holds the parent-edge table, the optional vertex table and the
root id, plus two derived tables that several operators share and that are
computed at most once:

* ``hot_parents()`` -- the bounded hot-key table of parents with very many
  children (see :mod:`arbor.plans.skew`), computed by one job and kept on the
  driver (at most ``arbor.skew.maxKeys`` rows).
* ``first_parent()`` -- one ``(src, parent)`` row per child, the smallest
  parent id, used by the single-answer upward walks.
* ``walk_table()`` -- the first parents laid out for the walks' joins
  (partitioned and sorted by child, persisted), built on the first walk and
  shared by every later walk over this hierarchy; ``release()`` drops it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.layout import dealt
from .plans.skew import SkewConf, hot_keys, hot_table, salt_many


@dataclass
class Hierarchy:
    edges: DataFrame
    vertices: DataFrame | None = None
    root: int = 1
    skew: SkewConf | None = None
    _hot_rows: list | None = field(default=None, repr=False)
    _derived: dict = field(default_factory=dict, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.edges.sparkSession

    def conf(self) -> SkewConf:
        if self.skew is None:
            self.skew = SkewConf.from_session(self.spark)
        return self.skew

    def hot_parent_rows(self) -> list:
        """``[(parent, buckets)]``: at most ``max_keys`` parents with very many children (one job, once)."""
        if self._hot_rows is None:
            self._hot_rows = [(r["key"], r["buckets"]) for r in hot_keys(self.edges, "dst", self.conf()).collect()]
        return self._hot_rows

    def hot_parents(self) -> DataFrame | None:
        """The hot parents as a small local table ``(key, buckets)``, or ``None`` when there are none."""
        return hot_table(self.spark, self.hot_parent_rows())

    def salted_edges(self) -> DataFrame:
        """``(src, dst, _salt)``: edges with hot parents' children spread over buckets."""
        return salt_many(self.edges.select("src", "dst"), "dst", "src", self.hot_parents())

    def first_parent(self) -> DataFrame:
        """``(src, parent)``: the smallest parent of each child; the root's own edges are ignored."""
        e = dealt(self.edges.where(F.col("src") != F.lit(self.root)).select("src", "dst"), "src")
        return e.groupBy("src").agg(F.min("dst").alias("parent"))

    def walk_table(self) -> DataFrame:
        """``(_ps, _pp)``: child and first parent, hash-partitioned and sorted by child, persisted once."""
        if "walk" not in self._derived:
            from .plans.layout import keyed

            fp = self.first_parent().select(F.col("src").alias("_ps"), F.col("parent").alias("_pp"))
            self._derived["walk"] = keyed(fp, "_ps")
        return self._derived["walk"]

    def derived(self, name: str, make):
        """A derived object kept for the life of this hierarchy (e.g. its motif hierarchy)."""
        if name not in self._derived:
            self._derived[name] = make()
        return self._derived[name]

    def release(self) -> None:
        """Unpersist the tables prepared for this hierarchy and its derived hierarchies."""
        for v in self._derived.values():
            if isinstance(v, DataFrame):
                v.unpersist()
            elif hasattr(v, "release"):  # a derived hierarchy or jump table
                v.release()
        self._derived.clear()

    def require_vertices(self) -> DataFrame:
        if self.vertices is None:
            raise ValueError("this operator needs the vertex table: Hierarchy(edges, vertices=...)")
        return self.vertices

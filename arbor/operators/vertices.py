"""Vertex table and name lookups.

``build_vertices`` groups name records by id into one row per vertex:
``(id, name, names)`` where ``names`` keeps every name in file order and
``name`` is the packed ``,n1,n2,`` string the reference exposes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NAME_SEP, packed_names


def build_vertices(names: DataFrame) -> DataFrame:
    """``(id, ord, name)`` records to ``(id bigint, name string, names array<string>)``.

    ``collect_list`` aggregates partially before the shuffle, so the exchange
    carries at most one partial list per id and map task.
    """
    grouped = names.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("ord").alias("o"), F.col("name").alias("n")))).alias("_r")
    )
    arr = F.transform(F.col("_r"), lambda r: r["n"])
    return grouped.select(
        F.col("id").cast("bigint").alias("id"), packed_names(arr).alias("name"), arr.alias("names")
    )


def find_ids(vertices: DataFrame, queries: DataFrame, name_col: str = "name") -> DataFrame:
    """For each distinct query name, the smallest id that has that exact name; -1 if none or empty.

    ``(name, vid)``. ``vertices`` is a vertex table or the name records
    ``(id, ord, name)`` themselves, which need no list of an id's names. The
    names are ``(name, id)`` pairs; a
    left-semi join keeps only asked-for names (a broadcast hash join when the
    questions are few), then ``min(id)`` aggregates partially per task, so a
    name shared by millions of ids collapses before any shuffle.
    """
    q = queries.select(F.col(name_col).cast("string").alias("name")).where(F.col("name").isNotNull()).distinct()
    pairs = vertices.select(F.col("id"), F.explode("names").alias("name")) if "names" in vertices.columns else (
        vertices.select(F.col("id").cast("bigint").alias("id"), "name"))
    hits = pairs.join(q, "name", "left_semi").groupBy("name").agg(F.min("id").alias("vid"))
    out = q.join(hits, "name", "left")
    vid = F.when(F.col("name") == F.lit(""), F.lit(-1)).otherwise(F.coalesce(F.col("vid"), F.lit(-1)))
    return out.select("name", vid.cast("bigint").alias("vid"))


def find_id_like(vertices: DataFrame, name: str) -> DataFrame:
    """Parity form of the name lookup: ``name LIKE '%,<name>,%'`` on the packed string.

    ``%`` and ``_`` in ``name`` act as wildcards, and a name containing a comma
    can match across two names, as in the reference. One row ``(name, vid)``.
    """
    spark = vertices.sparkSession
    if name == "":
        return spark.range(1).select(F.lit(name).alias("name"), F.lit(-1).cast("bigint").alias("vid"))
    pattern = f"%{NAME_SEP}{name}{NAME_SEP}%"
    hit = vertices.where(F.col("name").like(pattern)).agg(F.min("id").alias("vid"))
    return hit.select(F.lit(name).alias("name"), F.coalesce(F.col("vid"), F.lit(-1)).cast("bigint").alias("vid"))


def names_of(vertices: DataFrame, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """Packed name per distinct id: ``(vid, name)``; ``""`` for unknown ids and ids below 1."""
    q = ids.select(F.col(id_col).cast("bigint").alias("vid")).where(F.col("vid").isNotNull()).distinct()
    v = vertices.select(F.col("id").alias("vid"), F.col("name").alias("_n"))
    out = q.join(v, "vid", "left")
    name = F.when(F.col("vid") < 1, F.lit("")).otherwise(F.coalesce(F.col("_n"), F.lit("")))
    return out.select("vid", name.alias("name"))


def name_rows_of(names: DataFrame, ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """``(vid, ord, name)``: every name of each distinct id, one row each, out of the name records ``(id, ord, name)``.

    The form of :func:`names_of` for ids with any number of names: nothing is packed into one value. Unknown ids and
    ids below 1 have no rows. The records keep their place; the ids are the side that Spark may broadcast. A semi join
    asks once for a repeated id, so the ids are not gathered in a hash table of their own before it."""
    q = ids.select(F.col(id_col).cast("bigint").alias("vid")).where(F.col("vid") >= 1)
    return names.select(F.col("id").cast("bigint").alias("vid"), "ord", "name").join(q, "vid", "left_semi")

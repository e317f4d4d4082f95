"""Connected components of an edge table by alternating star rounds, each written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


#: Rounds are about the logarithm of the longest chain: more mean that something else is wrong.
ROUNDS = 200


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``id, component_id`` (the smallest id reachable) of every id in ``edges(a, b)``; ids without edges are absent.

    Large stars hang a node's larger neighbours on its smallest neighbour, small
    stars the smaller ones; the rounds end when nothing moves, after about the
    logarithm of the longest chain. A node's neighbours are never gathered: the
    smallest is a partial aggregate, and the join that follows is one that Spark
    splits where a node has very many. The result is the written table ``tag``;
    the rounds are deleted.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current = scratch.write(pairs, f"{tag}-0")
    before = None
    for step in range(1, ROUNDS + 1):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        current = scratch.write(small, f"{tag}-{step}")
        scratch.drop(f"{tag}-{step - 1}")
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError(f"components still move after {ROUNDS} rounds")
    label = current.groupBy("a").agg(F.min("b").alias("component_id")).withColumnRenamed("a", "id")
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    found = scratch.write(label.unionByName(roots), tag)
    scratch.drop(f"{tag}-{step}")
    return found

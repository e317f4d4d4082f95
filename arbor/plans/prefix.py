"""Running totals within groups, in DataFrame functions, without a task for a whole group.

A window over a group puts all its rows into one task. Here rows are range-partitioned by
``(group, order)``, each partition sums its own piece of a group, and the totals of the
pieces before are added: a group that holds a third of all rows is a third of the
partitions, and what is added is at most one row for each partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .materialize import RoundWriter


def running_totals(df: DataFrame, group: str, order: list[str], value: str, out: str, writer: RoundWriter, tag: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of ``group`` up to this one by ``order``.

    ``group`` and ``order`` together should be unique (equal rows stay in one partition, in any order).
    """
    pieces = writer.write(df.repartitionByRange(group, *order).withColumn("_piece", F.spark_partition_id()), tag)
    own = Window.partitionBy("_piece", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy(group, "_piece").agg(F.sum(value).alias("_t")).withColumn("_before", F.sum("_t").over(before))
    # only the group that goes on from the partition before has one: a row for each partition at most
    carried = writer.write(totals.where("_before IS NOT NULL").select(group, "_piece", "_before"), f"{tag}-carried")
    summed = pieces.withColumn(out, F.sum(value).over(own)).join(F.broadcast(carried), [group, "_piece"], "left")
    return summed.withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_piece", "_before")

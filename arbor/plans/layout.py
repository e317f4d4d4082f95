"""Lay a table out once for many joins on the same key.

Iterative operators join a changing, usually small, side (the current level,
the rows still walking up) with the same large table every round. Hash-
partitioning and sorting that large table once, then persisting it, lets every
round's sort-merge join read it as it is: only the small side is shuffled, and
the large side is neither re-shuffled nor re-sorted. A lost executor only means
its cached blocks are recomputed from the lineage.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(df: DataFrame, target_bytes: int = 256 << 20) -> int:
    """Partitions of about ``target_bytes`` by the plan's size estimate, at least the session's shuffle partitions.

    The count of a laid-out table is fixed (AQE cannot change it later), so it is
    taken from the data and not from the setting alone: 100 TB at 200 partitions
    would be 500 GB each. A plan without an estimate keeps the setting.
    """
    least = shuffle_partitions(df)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return least if size >= 1 << 60 else max(least, min(-(-size // target_bytes), 200_000))


def keyed(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """``df`` hash-partitioned and sorted on ``keys``, persisted (memory, spilling to disk)."""
    n = partitions or partitions_for(df)
    return df.repartition(n, *keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)


def dealt(df: DataFrame, *keys: str, target_bytes: int = 16 << 20) -> DataFrame:
    """``df`` hash-partitioned on ``keys`` before it is grouped by them, in parts of about ``target_bytes`` by the plan's estimate.

    For keys of which each has a few rows: a partial aggregate would hold every key of an input split, and its
    memory would follow the split. Here it follows the part, which adaptive execution does not merge with others."""
    return df.repartition(partitions_for(df, target_bytes), *keys)

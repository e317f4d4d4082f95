"""Helpers shared by the search operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def question_ids(ids: DataFrame, id_col: str = "vid") -> DataFrame:
    """Distinct non-null asked ids as ``vid bigint``; a repeated question is answered once."""
    return ids.select(F.col(id_col).cast("bigint").alias("vid")).where(F.col("vid").isNotNull()).distinct()


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

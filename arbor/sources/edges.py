"""Edge tables from any DataFrame, and Parquet snapshots of edges / vertices / index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Fixed value: every parent edge carries this relationship label.
EDGE_RELATIONSHIP = "parent"

EDGE_SCHEMA = StructType([
    StructField("src", LongType(), False),
    StructField("dst", LongType(), False),
    StructField("relationship", StringType(), True),
])


def edges_from(df: DataFrame, src: str = "src", dst: str = "dst", mode: str = "strict") -> DataFrame:
    """``(src, dst, relationship)`` child-to-parent edges from two id columns; self-loops removed.

    A null id fails the job in ``strict`` mode and drops its row in ``permissive`` mode.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be 'strict' or 'permissive', got {mode!r}")

    def checked(name: str):
        c = F.col(name).cast("bigint")
        return c if mode == "permissive" else F.coalesce(c, F.raise_error(F.lit(f"edge without {name} id")).cast("bigint"))

    out = df.select(checked(src).alias("src"), checked(dst).alias("dst"))
    if mode == "permissive":
        out = out.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return out.where(F.col("src") != F.col("dst")).select("src", "dst", F.lit(EDGE_RELATIONSHIP).alias("relationship"))


def empty_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EDGE_SCHEMA)


def write_snapshot(df: DataFrame, path: str, sort_by: str | list[str] | None = None) -> None:
    """Store a table as Parquet; ``sort_by`` (one column or several) clusters row groups so min/max
    pruning works on the first column. Give enough columns to make the key nearly unique: range
    partitioning cannot split rows with equal keys, so a key shared by a third of all rows would be
    one partition, written by one task."""
    if sort_by:
        df = clustered(df, [sort_by] if isinstance(sort_by, str) else list(sort_by))
    df.write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` range-partitioned and sorted on ``keys``, as :func:`write_snapshot` stores it."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

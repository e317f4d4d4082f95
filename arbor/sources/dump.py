"""Readers for ``|``-separated taxonomy dumps (``nodes.dmp``, ``names.dmp``).

Both are plain ``spark.read.text`` scans followed by built-in string functions,
so a multi-GB dump is split across tasks like any other text file; no RDD and
no Python per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import FIELD_SEPARATOR_REGEX, strip_pad, to_id
from .edges import EDGE_RELATIONSHIP, edges_from


def _fields(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.text(path)
    # Blank (or whitespace-only) lines carry no record; they are skipped in every mode.
    lines = lines.where(strip_pad(F.col("value")) != F.lit(""))
    return lines.select(
        F.split(F.col("value"), FIELD_SEPARATOR_REGEX).alias("f"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def read_edges(spark: SparkSession, path: str | list[str], mode: str = "strict") -> DataFrame:
    """Parent edges ``(src, dst, relationship)`` from ``id | parent_id | ...`` lines.

    ``mode='strict'`` fails the job on a line whose first two fields are not
    integers; ``mode='permissive'`` drops such lines. Self-loops (the root's
    edge to itself) are removed.
    """
    strict = _check_mode(mode)
    f = _fields(spark, path)
    raw = f.select(
        to_id(strip_pad(F.get(F.col("f"), 0)), strict).alias("src"),
        to_id(strip_pad(F.col("f")[1] if strict else F.get(F.col("f"), 1)), strict).alias("dst"),
    )
    return edges_from(raw, "src", "dst", mode)


def read_names(spark: SparkSession, path: str | list[str], mode: str = "strict") -> DataFrame:
    """Name records ``(id, ord, name)`` from ``id | name | ...`` lines.

    Every name class is kept, duplicates included. ``ord`` is a struct that sorts
    in file order (file, split start, position in the split), so the names of an
    id can be put back in the order the file lists them after a shuffle.
    """
    strict = _check_mode(mode)
    f = _fields(spark, path)
    out = f.select(
        to_id(strip_pad(F.get(F.col("f"), 0)), strict).alias("id"),
        F.struct(
            F.col("file_path"), F.col("block_start"), F.monotonically_increasing_id().alias("row")
        ).alias("ord"),
        strip_pad(F.col("f")[1] if strict else F.get(F.col("f"), 1)).alias("name"),
    )
    if not strict:
        out = out.where(F.col("id").isNotNull() & F.col("name").isNotNull())
    return out


def _check_mode(mode: str) -> bool:
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be 'strict' or 'permissive', got {mode!r}")
    return mode == "strict"


__all__ = ["read_edges", "read_names", "EDGE_RELATIONSHIP"]

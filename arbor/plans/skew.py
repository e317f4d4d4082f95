"""Salted joins for hot parents.

In a real hierarchy one parent can own a large share of all edges (a root with
millions of direct children, a genus with a million species). Every join that
looks up "the children of X" is keyed by the parent id, so such a parent lands in
one task. We split it:

* ``hot_keys`` counts rows per key once (partial aggregation, so hot keys
  collapse map-side before the shuffle) and keeps at most ``max_keys`` keys whose
  count passes ``min_rows``. The table is bounded by ``max_keys`` rows by
  construction, so bringing it to the driver and broadcasting it is safe at any
  data size; with no hot key the joins are left unsalted. Keys past the cap are
  still joined exactly (salt 0); AQE's skew-join split covers them.
* ``salt_many`` gives rows of the many-side a salt in ``[0, buckets)`` by hashing
  a second column (the child id), so a hot key's rows spread over ``buckets``
  tasks.
* ``salt_one`` copies each row of the one-side once per bucket of its key.

Joining on ``(key, salt)`` then gives exactly the rows of the plain join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


@dataclass(frozen=True)
class SkewConf:
    min_rows: int = 200_000       # a key is hot when it has at least this many rows
    # bound on the broadcast hot-key table (about 12 bytes a row, so under 1 MB). The table holds the
    # heaviest keys, so a key past the cap has at most 1/max_keys of all rows.
    max_keys: int = 65_536
    # bound on how far one key is split. A hot key gets ceil(rows / min_rows) buckets, so a bucket
    # holds about min_rows rows; the one-row side is copied once per bucket, at most
    # rows / min_rows + max_keys copies over all keys.
    max_buckets: int = 1 << 20

    @classmethod
    def from_session(cls, spark) -> "SkewConf":
        get = spark.conf.get
        return cls(
            min_rows=int(get("arbor.skew.minRows", str(cls.min_rows))),
            max_keys=int(get("arbor.skew.maxKeys", str(cls.max_keys))),
            max_buckets=int(get("arbor.skew.maxBuckets", str(cls.max_buckets))),
        )


def hot_keys(df: DataFrame, key: str, conf: SkewConf) -> DataFrame:
    """``(key, buckets)`` for the heaviest keys; at most ``conf.max_keys`` rows."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    top = counts.where(F.col("rows") >= conf.min_rows).orderBy(F.col("rows").desc()).limit(conf.max_keys)
    buckets = F.least(F.ceil(F.col("rows") / F.lit(conf.min_rows)), F.lit(conf.max_buckets)).cast("int")
    return top.select("key", F.greatest(buckets, F.lit(2)).alias("buckets"))


def heavy_keys(df: DataFrame, key: str, conf: SkewConf, total: int) -> DataFrame:
    """``(key, rows)`` of the keys with at least ``min_rows`` and one in ``max_keys`` of all ``total`` rows.

    At most ``max_keys`` keys can pass that, so neither a sort nor a limit is needed: partial counts in the
    tasks, sums in the reducers, and only what passes leaves them."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") >= max(conf.min_rows, -(-total // conf.max_keys)))


def hot_table(spark, rows: list[tuple[int, int]], key_type: str = "bigint") -> DataFrame | None:
    """The collected hot keys as a small local table, or ``None`` when no key is hot."""
    if not rows:
        return None
    return spark.createDataFrame([(k, int(b)) for k, b in rows], f"key {key_type}, buckets int")


def _buckets(df: DataFrame, key: Column, hot: DataFrame) -> DataFrame:
    h = F.broadcast(hot.select(F.col("key").alias("_hk"), F.col("buckets").alias("_hb")))
    return df.join(h, key == F.col("_hk"), "left")


def salt_many(df: DataFrame, key: str, spread: str, hot: DataFrame | None) -> DataFrame:
    """Add ``_salt``: a hash bucket of ``spread`` for hot keys, 0 otherwise (always 0 without hot keys)."""
    if hot is None:
        return df.withColumn(SALT, F.lit(0))
    out = _buckets(df, F.col(key), hot)
    salt = F.when(F.col("_hb").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col(spread)), F.col("_hb")))
    return out.withColumn(SALT, salt.cast("int")).drop("_hk", "_hb")


def salt_one(df: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Add ``_salt``: one copy per bucket for hot keys, a single copy with 0 otherwise."""
    if hot is None:
        return df.withColumn(SALT, F.lit(0))
    out = _buckets(df, F.col(key), hot)
    salts = F.when(F.col("_hb").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_hb") - 1))
    return out.withColumn(SALT, F.explode(salts.cast("array<int>"))).drop("_hk", "_hb")

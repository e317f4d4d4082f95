"""Write a DataFrame once to the shared checkpoint folder and read it back.

Iterative operators (the level-by-level index build, the upward walks) would
otherwise grow a plan with one join per round and recompute every earlier round
when an executor is lost. Each round is written as Parquet under the session's
checkpoint folder, so a lost executor costs at most the current round, the plan
stays one join deep, and the next round reads a columnar table with statistics
(Catalyst can broadcast a round that turned out small).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import checkpoint_root


_RUNS: dict[str, list[str]] = {}


def drop_runs(spark: SparkSession) -> int:
    """Delete the folders of all runs of this application; returns how many there were."""
    folders = _RUNS.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for base in folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(base)
        folder.getFileSystem(conf).delete(folder, True)
    return len(folders)


class RoundWriter:
    """Names the Parquet folders of one iterative run: ``<ckpt>/arbor/<run>/round=<tag>``.

    A round may be split by a column of finished and open rows (``split``), which
    becomes a partition column: reading only finished rows then lists and scans
    only their files, and :meth:`release` drops the open rows' folders, which
    later rounds no longer need.
    """

    def __init__(self, df_or_spark, name: str):
        spark = getattr(df_or_spark, "sparkSession", df_or_spark)
        self.spark = spark
        self.base = f"{checkpoint_root(spark)}/arbor/{name}-{uuid.uuid4().hex[:12]}"
        self.paths: dict[str, str] = {}
        _RUNS.setdefault(spark.sparkContext.applicationId, []).append(self.base)

    def write(self, df: DataFrame, tag: str, split: str | None = None) -> DataFrame:
        path = f"{self.base}/round={tag}"
        out = df.write.mode("overwrite").option("compression", "zstd")
        (out.partitionBy(split) if split else out).parquet(path)
        self.paths[tag] = path
        # An empty round may leave no data file to infer from: pass the schema.
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, tags: list[str], schema) -> DataFrame:
        """Several written rounds as one Parquet scan (one file listing, filters pushed to every file)."""
        rows = self.spark.read.schema(schema).option("basePath", self.base).parquet(*[self.paths[t] for t in tags])
        return rows.select(*schema.names)  # without the round's name

    def drop(self, tag: str) -> None:
        """Delete one round that nothing reads any more."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(tag))
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def release(self, split: str | None = None, *, keep: tuple[str, ...] = ()) -> None:
        """Delete this run's folders, or only the partitions of ``split`` whose value is not in ``keep``."""
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths.values():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            fs = folder.getFileSystem(conf)
            if not fs.exists(folder):
                continue
            if split is None:
                fs.delete(folder, True)
                continue
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                if name.startswith(f"{split}=") and name.split("=", 1)[1] not in keep:
                    fs.delete(status.getPath(), True)

"""Helpers shared by the text operators: input projection, Arrow batches of bounded size, scratch tables.

Every operator selects just the columns it reads, under its own names, so extra
columns of the input (also ones named like an operator's outputs) never clash.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import ensure_checkpoint_dir

#: Text bytes that one step of a Python task works on; bounds its memory, not its input.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a private one only where that is unset (local sessions)."""
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


class Scratch:
    """Tables that an operator writes once and reads back, so that lineage is cut on shared storage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/arbor-llm/{name}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = f"{self.base}/{tag}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tags: str) -> None:
        """Delete tables that nothing reads any more (without tags: all of them)."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for path in [f"{self.base}/{t}" for t in tags] or [self.base]:
            folder = hadoop.Path(path)
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Rows that Spark hands to a Python task at once: documents are long rows, and its default of 10,000 is not made for them.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Prepare a session for Python tasks over texts.

    The package is handed to the executors' Python workers once per application
    (as ``--py-files`` would), and batches of more than ``BATCH_ROWS`` rows are
    turned down to that; a smaller setting is left alone.
    """
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else it already comes from an archive
        name = os.path.basename(package)
        path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, files in os.walk(package):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.join(name, os.path.relpath(full, package)))
        spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches where ``column`` (a string column) passes ``limit`` bytes; every row stays in one slice."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(column)
        # offsets of string / large_string arrays, relative to the (possibly sliced) buffer
        width = np.int64 if pa.types.is_large_string(col.type) else np.int32
        offsets = np.frombuffer(col.buffers()[1], dtype=width)[col.offset:col.offset + n + 1].astype(np.int64)
        start = 0
        while start < n:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), n)
            yield batch.slice(start, end - start)
            start = end


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Batches of short rows put together to ``rows`` rows or a little more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def map_text(df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], dict | None], schema: str,
             limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of bounded text size; ``fn`` returns the output columns as a dict of arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, limit):
            cols = fn(part)
            if cols is not None:
                yield pa.RecordBatch.from_arrays(
                    [cols[f.name] if isinstance(cols[f.name], pa.Array) and cols[f.name].type == f.type
                     else pa.array(cols[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts as Python strings; a null text counts as empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a name like it that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_ids(docs: DataFrame, ids: DataFrame, how: str, id_col: str = "doc_id") -> DataFrame:
    """``docs`` whose id is (``left_semi``) or is not (``left_anti``) in the one column of ``ids``."""
    name = fresh(docs, "_id")
    return docs.join(ids.toDF(name), F.col(id_col) == F.col(name), how)

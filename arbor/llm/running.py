"""Running sums of sorted groups, without a task for a whole group.

Rows are range-partitioned and sorted by ``(group, order)``; each task sums along its
own rows, and a table with one row for each partition tells what the groups that cross
partition borders carry over. A group that holds a third of all rows is spread over a
third of the partitions like any other rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, gathered, ship

_OWN = "_part long, _row long"


def running_sums(df: DataFrame, group: str, order: list[Column], values: list[str], scratch: Scratch, tag: str) -> DataFrame:
    """``df`` with each column of ``values`` (64-bit, never null) replaced by its running sum within ``group``.

    Sums wrap around at 64 bits. ``group`` is a long column that is never null. ``order`` should tell
    rows of a group apart as far as it can: rows that are equal by it stay in one partition. The result
    is read from the written table ``tag``. The driver sees one row for each partition.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    names = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", " + _OWN
    out = to_arrow_schema(df.schema)
    keys = [F.col(group), *order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, of = TaskContext.get().partitionId(), 0, None
        before = np.zeros(len(values), np.int64)
        for batch in gathered(batches):
            own = batch.column(group).to_numpy()
            starts = np.flatnonzero(np.concatenate([[own[0] != of], own[1:] != own[:-1]]))
            at = np.searchsorted(starts, np.arange(len(own)), side="right")  # 0: still the group of the batch before
            cols = {}
            for i, v in enumerate(values):
                total = np.cumsum(batch.column(v).to_numpy(zero_copy_only=False), dtype=np.int64)
                ahead = np.concatenate([-before[i:i + 1], np.concatenate([np.zeros(1, np.int64), total])[starts]])
                cols[v] = total - ahead[at]
                before[i] = cols[v][-1]
            of = own[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[n], out.field(n).type) if n in cols else batch.column(n) for n in names]
                + [pa.array(np.full(len(own), part), pa.int64()), pa.array(np.arange(row, row + len(own)), pa.int64())],
                names=[*names, "_part", "_row"])
            row += len(own)

    done = scratch.write(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), tag)
    ends = done.groupBy("_part").agg(
        F.min_by(group, "_row").alias("head"), F.max_by(group, "_row").alias("tail"),
        *[F.max_by(v, "_row").alias(f"end{i}") for i, v in enumerate(values)]).orderBy("_part").collect()
    carried, tail, sums = [], None, np.zeros(len(values), np.int64)
    for r in ends:
        over = sums.copy() if tail == r["head"] else np.zeros(len(values), np.int64)
        if over.any():
            carried.append((r["_part"], r["head"], *map(int, over)))
        sums = np.array([r[f"end{i}"] for i in range(len(values))], np.int64) + (over if r["head"] == r["tail"] else 0)
        tail = r["tail"]
    if not carried:
        return done.select(*names)
    # at most one row for each partition
    carry = done.sparkSession.createDataFrame(carried, ", ".join(["_at long", "_head long", *[f"_over{i} long" for i in range(len(values))]]))
    joined = done.join(F.broadcast(carry), (F.col("_part") == F.col("_at")) & (F.col(group) == F.col("_head")), "left")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = []
            for n in names:
                col = batch.column(n)
                if n in values:
                    col = pc.add(col.cast(pa.int64()), pc.fill_null(batch.column(f"_over{values.index(n)}"), 0))  # wraps
                cols.append(col.cast(out.field(n).type))
            yield pa.RecordBatch.from_arrays(cols, schema=out)

    return joined.mapInArrow(add, df.schema)

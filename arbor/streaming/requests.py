"""Answer a stream of question ids with a batch operator.

The reference answers one id per web request. Here requests arrive as a
streaming DataFrame (for instance new files of ids in a folder); each
micro-batch is answered by any batch operator of this package — a
stream-static join against the stored index and vertex table — and the answers
are written to a Parquet sink. The streaming checkpoint is a folder that does
not change between applications: the one given, or a folder named after the
query under ``spark.checkpoint.dir`` as the session sets it. A query restarted
by a new application with the same folder therefore resumes where it stopped.
A session without ``spark.checkpoint.dir`` has no such folder, so there the
checkpoint must be given.

Each micro-batch's questions are first stored in a folder beside the stream's
checkpoint (so the answer is planned with their real size), and its answers
overwrite their own folder ``<sink>/batch=<id>``: a batch that
is run again after a failure replaces its earlier, possibly partial, output
instead of adding a second copy, so the sink holds every answer exactly once.
Reading ``<sink>`` gives the answers plus a ``batch`` column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.session import configured_checkpoint_dir


def answer_stream(questions: DataFrame, answer: Callable[[DataFrame], DataFrame], sink_path: str,
                  name: str = "answers", available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Start a query writing ``answer(batch)`` for every micro-batch of ``questions`` to ``sink_path``.

    ``answer`` is a batch operator over the batch's DataFrame, e.g.
    ``lambda q: documents.children_doc(index, vertices, q)``.
    """
    if checkpoint is None:
        root = configured_checkpoint_dir(questions.sparkSession)
        if root is None:
            raise ValueError("spark.checkpoint.dir is not set: give the stream's checkpoint folder, or a restart would begin anew")
        checkpoint = f"{root}/arbor-stream/{name}"
    ckpt = checkpoint.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        # The batch's questions are written once and read back: the answer's plan then sees their real
        # (usually small) size and broadcasts them into index scans instead of shuffling the index, and
        # a lost executor does not re-read the stream source.
        asked = f"{ckpt}-questions/batch={batch_id}"
        batch.write.mode("overwrite").parquet(asked)
        read = batch.sparkSession.read.schema(batch.schema).parquet(asked)
        answer(read).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch={batch_id}")

    writer = questions.writeStream.queryName(name).option("checkpointLocation", ckpt).foreachBatch(run)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

"""Streams of requests: answers, a replayed batch, and a restart by a new application."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

import pytest

from arbor import build_index
from arbor.operators import documents
from arbor.plans import session as sessions
from arbor.streaming.requests import answer_stream

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ask(folder, name, ids):
    with open(os.path.join(folder, name), "w") as f:
        f.write("vid\n" + "".join(f"{i}\n" for i in ids))


def test_stream_of_requests_gets_children_documents(spark, mini):
    index = build_index(mini, 3).cache()
    incoming = tempfile.mkdtemp(prefix="arbor-requests-")
    out = tempfile.mkdtemp(prefix="arbor-answers-")
    ask(incoming, "batch-1.csv", [1, 12884])
    questions = spark.readStream.schema("vid bigint").option("header", "true").csv(incoming)
    q = answer_stream(questions, lambda b: documents.children_doc(index, mini.vertices, b), os.path.join(out, "docs"),
                      available_now=True, checkpoint=os.path.join(out, "checkpoint"))
    q.awaitTermination(120)
    rows = spark.read.parquet(os.path.join(out, "docs")).collect()
    assert sorted(r.vid for r in rows if r.level == 0) == [1, 12884]
    assert sorted(json.loads(r.json)["ID"] for r in rows if r.vid == 12884 and r.level == 1) == [185751, 185752, 265963]


def test_replayed_batch_replaces_its_earlier_output(spark, mini):
    # a batch that ran before a failure left partial output in its folder; the replay must replace it
    index = build_index(mini, 3).cache()
    incoming = tempfile.mkdtemp(prefix="arbor-requests-")
    out = tempfile.mkdtemp(prefix="arbor-answers-")
    sink = os.path.join(out, "docs")
    stale = documents.children_doc(index, mini.vertices, spark.createDataFrame([(10239,)], "vid bigint"))
    stale.write.parquet(os.path.join(sink, "batch=0"))
    ask(incoming, "batch-1.csv", [12884])
    questions = spark.readStream.schema("vid bigint").option("header", "true").csv(incoming)
    q = answer_stream(questions, lambda b: documents.children_doc(index, mini.vertices, b), sink,
                      available_now=True, checkpoint=os.path.join(out, "checkpoint"))
    q.awaitTermination(120)
    rows = spark.read.parquet(sink).collect()
    assert {(r.vid, r.batch) for r in rows} == {(12884, 0)} and len(rows) == 4


SESSION = """
import sys
from pyspark.sql import functions as F
from arbor.plans.session import local_session
from arbor.streaming.requests import answer_stream
root, incoming, sink = sys.argv[1:]
spark = local_session(cpus=2, shuffle_partitions=2, extra={"spark.checkpoint.dir": root})
asked = spark.readStream.schema("vid bigint").option("header", "true").csv(incoming)
answer_stream(asked, lambda q: q.select("vid", (F.col("vid") * 10).alias("x")), sink, available_now=True).awaitTermination(120)
spark.stop()
"""


def test_a_new_application_resumes_the_stream():
    out = tempfile.mkdtemp(prefix="arbor-restart-")
    incoming, sink = os.path.join(out, "in"), os.path.join(out, "docs")
    os.mkdir(incoming)
    env = {**os.environ, "PYTHONPATH": REPO}
    for n, ids in enumerate(([1, 2], [3])):
        ask(incoming, f"batch-{n}.csv", ids)
        subprocess.run([sys.executable, "-c", SESSION, os.path.join(out, "shared"), incoming, sink], check=True, env=env, timeout=200)
    import pyarrow.dataset as ds

    rows = ds.dataset(sink, partitioning="hive").to_table().to_pylist()
    assert sorted((r["vid"], r["batch"]) for r in rows) == [(1, 0), (2, 0), (3, 1)]


def test_a_session_without_a_shared_folder_needs_a_checkpoint(spark, monkeypatch):
    from arbor.streaming import requests

    monkeypatch.setattr(requests, "configured_checkpoint_dir", lambda s: None)
    with pytest.raises(ValueError):
        answer_stream(spark.readStream.format("rate").load(), lambda q: q, "/nowhere")


def test_a_session_without_adaptive_execution_is_refused(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(RuntimeError):
            sessions.prepare_session(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    sessions.prepare_session(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"

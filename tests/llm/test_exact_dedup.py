"""Exact deduplication against a plain Python version."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from arbor.llm import exact_dedup

from .helpers import clashing, rows

SCHEMA = "doc_id long, text string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(data):
    by = {}
    for i, (d, t) in enumerate(data):
        by.setdefault(lower(t), []).append((-float("inf") if d is None else d, i))
    out = []
    for i, (d, t) in enumerate(data):
        own = by[lower(t)]
        keep = max(own)
        out.append((d, None if keep[0] == -float("inf") else keep[0], len(own), keep[0] == (-float("inf") if d is None else d),
                    hashlib.sha256(lower(t).encode()).hexdigest()))
    return out


def some(seed=1):
    rng = random.Random(seed)
    texts = ["", None, "Hot text", "hot TEXT", "É", "é", "İ", "x" * 300_000, "X" * 300_000, "a b", "a  b", "straße", "STRASSE"]
    data = [(i, rng.choice(texts)) for i in range(150)] + [(i, "Hot text") for i in range(200, 320)] + [(i, f"t{i}") for i in range(400, 480)]
    rng.shuffle(data)
    return data


def test_every_row_meets_its_group(spark):
    data = some()
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    got = rows(exact_dedup.report(exact_dedup.groups(clashing(df))))
    assert got == sorted(brute(data), key=repr)


def test_digests_that_clash_are_told_apart_by_content(spark):
    data = some(2)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    found = exact_dedup.groups(df, digest=lambda c: F.encode(F.lit("same"), "utf-8"))
    assert rows(found.select("doc_id", "keep_id", "group_size", "kept")) == sorted([r[:4] for r in brute(data)], key=repr)
    # a few texts to a digest, others with one of their own
    found = exact_dedup.groups(df, digest=lambda c: F.encode(F.substring(F.sha2(c, 256), 1, 1), "utf-8"))
    assert rows(found.select("doc_id", "keep_id", "group_size", "kept")) == sorted([r[:4] for r in brute(data)], key=repr)


def test_without_hot_digests(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 1)
    data = some(3)
    got = rows(exact_dedup.report(exact_dedup.groups(spark.createDataFrame(data, SCHEMA))))
    assert got == sorted(brute(data), key=repr)


def test_repeated_rows_and_missing_ids(spark):
    data = [(5, "a"), (5, "A"), (4, "a"), (None, "a"), (None, "b"), (None, "B"), (7, "c"), (7, "d"), (-3, None), (None, "")]
    found = exact_dedup.groups(spark.createDataFrame(data, SCHEMA))
    got = [tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept").collect()]
    assert sorted(got, key=repr) == sorted([
        (5, 5, 4, True), (5, 5, 4, False), (4, 5, 4, False), (None, 5, 4, False), (None, None, 2, True), (None, None, 2, False),
        (7, 7, 1, True), (7, 7, 1, True), (-3, -3, 2, True), (None, -3, 2, False)], key=repr)


def test_kept_rows_with_all_their_columns(spark):
    data = [(1, "a", "p"), (2, "A", "q"), (2, "a", "q"), (3, "b", None), (None, "c", "r"), (None, "c", "r")]
    df = spark.createDataFrame(data, "doc_id long, text string, digest string")
    got = exact_dedup.deduplicate(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["text"].lower(), r["digest"]) for r in got.where("doc_id IS NOT NULL").collect()) == [(2, "a", "q"), (3, "b", None)]
    assert got.where("doc_id IS NULL").count() == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.report(exact_dedup.groups(df)).collect() == []
    assert exact_dedup.deduplicate(df).collect() == []


def test_no_python_and_one_shuffle_of_texts(spark):
    plan = exact_dedup.groups(spark.createDataFrame(some(4), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "content" not in plan.split("== Physical Plan ==")[-1]

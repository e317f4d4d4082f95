"""Prefix trie against a plain Python version, with components cut in tasks and over many rounds."""

from __future__ import annotations

import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from arbor.llm import prefix_trie
from arbor.llm.common import Scratch
from arbor.llm.running import running_sums

from .helpers import clashing, rows

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(r, t):
    return hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()


def brute(data, block=100, most=6):
    convs = {}
    for c, n, r, t in data:
        if c is not None:
            r, t = r or "", t or ""
            convs.setdefault(c, []).append((n is not None, n or 0, digest(r, t), (r, t)))
    convs = {c: [x[-1] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % most
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        built[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {k: 0 for k in members}
    for k in members:
        if k:
            kids[k[:-1]] += 1
    leaves, tokens = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            tokens[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if built[c] == k)))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], tokens[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def some(seed, convs=260, deep=120):
    rng = random.Random(seed)
    data = []
    for c in [*range(convs), 1000, 1001, 1005, 1107, -3, -120, 2**40]:
        n = rng.choice([1, 2, 3, 4, 8, 12])
        data += [(c, i, rng.choice(["user", "bot"]), f"t{rng.randrange(3)}é😀"[:rng.randrange(1, 5)]) for i in range(n)]
    data += [(777, i, "user", "chain") for i in range(deep)] + [(778, i, "user", "chain") for i in range(deep // 2)]
    data += [(c, i, "user", "same") for c in range(5000, 5060) for i in range(5)]
    data += [(2000, None, "b", None), (2000, None, None, "a"), (2000, 1, "x", "y"), (2000, 1, "x", "y"), (None, 1, "lost", "row"), (2001, 0, "", "")]
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("local", [1, 1 << 16])
def test_against_plain_python(spark, local):
    data = some(local)
    df = clashing(spark.createDataFrame(data, SCHEMA)).repartition(5)
    got = prefix_trie.trie(df, local=local)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes[:-1]} == {"bigint"}
    assert rows(got) == brute(data)


def test_components_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BROADCAST", 0)
    data = some(4, convs=120, deep=40)
    assert rows(prefix_trie.trie(spark.createDataFrame(data, SCHEMA), local=20)) == brute(data)


def test_a_chain_takes_logarithmically_many_rounds(spark):
    data = [(0, i, "user", f"{i}") for i in range(300)]
    scratch = Scratch(spark, "chain")
    n = 301
    nodes = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(0).cast("long").alias("m"), F.col("id").alias("d"),
                                  (F.lit(n) - F.col("id")).alias("r"), (F.col("id") == n - 1).cast("long").alias("leaf"), F.col("id").alias("saved"))
    lookup = nodes.where("d > 0").select("m", "d", "id", "parent")
    written = []
    scratch_write = scratch.write
    scratch.write = lambda df, tag: (written.append(tag), scratch_write(df, tag))[1]
    got = {r["id"]: (r["leaves"], r["tokens"]) for r in prefix_trie.rollup(nodes, lookup, scratch, local=1).collect()}
    assert got == {i: (1, sum(range(i, n))) for i in range(n)}
    assert sum(t.startswith("round-") for t in written) <= 9
    assert len(data) == n - 1


def test_small_and_empty_tables(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []
    for data in ([(1, 0, "a", "b")], [(c, 0, "a", "b") for c in (1, 2, 3)], [(c, 0, "long", "x" * 100_000) for c in (7, 107)]):
        assert rows(prefix_trie.trie(spark.createDataFrame(data, SCHEMA))) == brute(data)


def test_running_sums_of_groups_over_partitions(spark):
    rng = random.Random(8)
    data = [(rng.choice([1, 1, 1, 2, 3, 4]), i, rng.choice([1, -5, 2**62])) for i in range(500)]
    df = spark.createDataFrame(data, "g long, i long, v long").repartitionByRange(7, "g", "i")
    got = running_sums(df, "g", [F.col("i")], ["v"], Scratch(spark, "sums"), "t")
    want, total = [], {}
    for g, i, v in data:
        total[g] = total.get(g, 0) + v
        want.append((g, i, (total[g] + 2**63) % 2**64 - 2**63))
    assert rows(got) == sorted(want, key=repr)

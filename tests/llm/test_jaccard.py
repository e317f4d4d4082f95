"""The Jaccard join against brute force, and components against union-find."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from arbor.llm import jaccard
from arbor.llm.common import Scratch
from arbor.llm.components import components

from .helpers import clashing, prose


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(30):
        base = prose(rng, rng.choice([1, 2, 3, 5, 20, 60, 150]), 40).split()
        for _ in range(rng.choice([1, 2, 8, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(40)}"
            text = (" " if rng.random() < 0.7 else " \t\n").join(words)
            rows.append((i * 7 % 10007, text.upper() if rng.random() < 0.3 else text))
            i += 1
    return rows + [(20001, None), (20002, ""), (20003, " \n"), (20004, "Ünï x"), (20005, "ÜNÏ x")]


@pytest.mark.parametrize("k, percent, order, block", [(3, 90, 1 << 19, 1024), (5, 80, 1 << 19, 16), (3, 90, 0, 8), (2, 100, 50, 1024)])
def test_components_are_exact(spark, monkeypatch, k, percent, order, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(k)
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, k, percent, order).collect()}
    assert got == brute(rows, k, percent)


def test_long_repeated_and_null_rows(spark):
    rng = random.Random(9)
    long = prose(rng, 60_000, 10**6)
    rows = [(1, long), (2, long + " tail words"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (4, "x")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    n = len(set(zip(*[long.split()[i:] for i in range(3)])))
    assert got == sorted([(1, n, 1), (2, n + 2, 1), (3, 2, 3), (3, 2, 3), (None, 2, None), (4, 1, 4)], key=repr)


def test_rows_with_the_same_id_are_one_node(spark):
    rng = random.Random(12)
    a, b, c = (prose(rng, 40, 10**6) for _ in range(3))
    rows = [(3, a), (7, a), (7, b), (7, ""), (9, b), (11, c), (12, ""), (12, c), (5, None)]
    for near in ("", " one more"):  # equal texts, then texts that are verified
        data = [(i, t and t + near * (i in (7, 12))) for i, t in rows]
        got = sorted((r.doc_id, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 3, 90).collect())
        assert got == [(3, 3), (5, 5), (7, 3), (7, 3), (7, 3), (9, 3), (11, 11), (12, 11), (12, 11)]


def test_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_group_of_near_copies_emits_few_pairs(spark):
    # 300 copies of one text with one own word each: all pairs would be 44,850
    rng = random.Random(1)
    base = prose(rng, 200, 10**6).split()
    rows = []
    for i in range(300):
        words = list(base)
        words[i % 200] = f"own{i}"
        rows.append((i, " ".join(words)))
    got = {r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == {0}


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [
        (rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(260)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component_id for r in components(df, Scratch(spark, "test-components"), "t").collect()}
    assert got == {x: find(x) for x in root if any(a != b and x in (a, b) for a, b in edges)}
    assert components(df.where(F.lit(False)), Scratch(spark, "test-components"), "e").collect() == []

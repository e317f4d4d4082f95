"""Importance resampling against a plain Python version with zlib's CRC of every n-gram."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from arbor.llm import importance

from .helpers import clashing, rows

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, most):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, least, seed, buckets, most):
    at = lambda g: crc32(g.encode()) % buckets
    s, t = Counter(at(g) for _, x in docs for g in grams(x, most)), Counter(at(g) for x in target for g in grams(x, most))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for d, x in docs:
        own = [gain[at(g)] for g in grams(x, most)]
        weight = sum(own) // len(own) if own else 0
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(own), weight, score, None])
    may = [r for r, (d, x) in zip(out, docs) if d is not None and len(words(x)) >= least]
    may.sort(key=lambda r: (-r[3], r[0], r[1], r[2]))
    for i, r in enumerate(may[:len(may) * percent // 100]):
        r[4] = i + 1
    return [tuple(r) for r in out]


def some(seed, n=120):
    rng = random.Random(seed)
    parts = ["Alpha", "beta", "ÉTÉ", "été", "x1", "日本", "9", "a" * 70, "b" * 300, "don't", "A-b_c", "\x7f", "😀", "\t", "ß"]
    docs = [(rng.randrange(-5, 200), " ".join(rng.choices(parts, k=rng.randrange(60)))) for _ in range(n)]
    docs += [(None, "Alpha beta " * 20), (300, None), (301, ""), (302, "--- ---"), (303, "one"), (304, "w " * 30_000), (305, "y" * 200_000),
             (306, "same text " * 12), (306, "same text " * 12), (306, "other text " * 14), (307, "Étude " * 25), (308, "\x00a\x00")]
    rng.shuffle(docs)
    return docs, [" ".join(rng.choices(parts, k=30)) for _ in range(10)] + [None, ""]


@pytest.mark.parametrize("most,buckets,percent,least", [(2, 10_000, 25, 20), (3, 97, 60, 1)])
def test_against_plain_python(spark, most, buckets, percent, least):
    docs, target = some(most)
    df = clashing(spark.createDataFrame(docs, SCHEMA)).repartition(6)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(df, bench, percent, least, 7, buckets, most)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(got) == sorted(brute(docs, target, percent, least, 7, buckets, most), key=repr)


def test_crcs_of_all_ngrams_from_prefixes():
    rng = random.Random(3)
    own = [bytes(rng.choices(range(33, 255), k=rng.choice([1, 2, 7, 63, 64, 65, 500, 5000]))) for _ in range(400)]
    cut = 150
    state = np.array(importance.prefix_states(own[:cut]) + importance.prefix_states(own[cut:]), np.uint32)
    follows = np.array([i not in (0, cut) for i in range(len(own))])
    for n in (1, 2, 3, 5):
        crc, first = importance.ngram_crcs(state, np.array(list(map(len, own))), follows, n)
        runs = [i for i in range(len(own) - n + 1) if i >= cut or i + n <= cut]
        assert first.tolist() == runs and crc.tolist() == [crc32(b" ".join(own[i:i + n])) for i in runs]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    docs, _ = some(5, 20)
    assert importance.resample(none, none).collect() == []
    assert rows(importance.resample(spark.createDataFrame(docs, SCHEMA), none)) == sorted(brute(docs, [], 25, 20, 7, 10_000, 2), key=repr)


def test_ties_over_partitions(spark):
    docs = [(7, "same words here again " * 6)] * 200 + [(i, "same words here again " * 6) for i in range(40)]
    got = importance.resample(spark.createDataFrame(docs, SCHEMA).repartition(9), spark.createDataFrame([], SCHEMA), percent=50)
    assert rows(got) == sorted(brute(docs, [], 50, 20, 7, 10_000, 2), key=repr)

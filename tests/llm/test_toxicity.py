"""Toxicity: held-out accuracy, the models' probabilities, edge cases."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from arbor.llm import toxicity
from arbor.llm.common import Scratch
from arbor.llm.hashing import words

from .helpers import clashing

INSULTS = ["idiot", "scum", "moron", "clown"]


def corpus(n=900, seed=7):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(20, 120))]
        toxic = i % 6 == 0
        for _ in range(rng.randrange(1, 5) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", ".", ","])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus()
    extra = [(5000, None), (5001, ""), (None, "idiot idiot"), (1, rows[1][1]), (5002, "plain " * 50_000), (5003, "You IDIOT! scum, moron")]
    d = clashing(spark.createDataFrame(rows + extra, "doc_id long, text string"))
    lab = spark.createDataFrame(labels + [(None, 1, 1), (2, None, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    return toxicity.score_toxicity(d, lab).collect(), dict((i, t) for i, _, t in labels)


def test_held_out_rows_are_told_apart(scored):
    got, toxic = scored
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert len(held) > 200
    assert sum(r.predicted == toxic[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_held_out_is_the_remainder_of_the_id(scored):
    for r in scored[0]:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_defined_cases(scored):
    got, _ = scored
    by = {r.doc_id: r for r in got}
    assert by[5000].score == by[5001].score and by[5000].predicted == 0
    assert by[5003].predicted == 1 and by[None].predicted == 1 and by[5002].predicted == 0
    assert len(got) == 906 and len({r.score for r in got if r.doc_id == 1}) == 1


def test_labels_of_held_out_rows_are_not_used(spark):
    rows, labels = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    one, two = ({r.doc_id: r.score for r in toxicity.score_toxicity(
        docs, spark.createDataFrame(own, "doc_id long, quality int, toxic int")).collect()} for own in (labels, turned))
    assert max(abs(one[i] - two[i]) for i in one) < 1e-9


def test_no_labels_no_documents_one_class(spark):
    rows, labels = corpus(60)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(d.where("false"), lab).collect() == []
    for own in (lab.where("false"), lab.where("toxic = 0")):
        got = {r.score for r in toxicity.score_toxicity(d, own).collect()}
        assert len(got) == 1 and 0 <= got.pop() <= 1


def test_models_back_off_to_common_counts():
    t = {f"{k}{c}": np.zeros(1 << (toxicity.PAIR_BITS if k == "pair" else toxicity.WORD_BITS), np.int32)
         for k in ("pair", "history", "follows", "followed") for c in (0, 1)}
    t["shared"] = np.zeros(1 << toxicity.WORD_BITS, np.int32)
    t["followed0"][:4], t["followed1"][:4], t["shared"][:4] = [50, 50, 0, 1], [50, 0, 50, 1], [100, 50, 50, 2]
    first = toxicity.Models(t).first
    assert first[2] > 1 > -1 > first[1] and abs(first[0]) < 0.5 and abs(first[3]) < 0.5
    assert abs(first[1000]) < 1  # a word that neither class has is left to the common part


def test_no_two_words_share_counts(spark):
    """Two words whose hashes begin with the same 20 bits, one only in toxic rows and one only in others, in ever new contexts."""
    names = [f"word{i}" for i in range(6000)]
    cell = words(pa.array([" ".join(names)]), terms=True)[0] >> np.uint64(44)
    order = np.argsort(cell, kind="stable")
    at = np.flatnonzero(cell[order][1:] == cell[order][:-1])[0]
    bad, good = names[order[at]], names[order[at + 1]]
    rows = [(i, " ".join(f"f{i}x{k} {w}" for k, w in enumerate([bad if i % 2 else good] * 12))) for i in range(300)]
    got = toxicity.score_toxicity(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")).collect()
    score = {c: [r.score for r in got if r.held_out and r.doc_id % 2 == c] for c in (0, 1)}
    assert min(score[1]) > 0.9 and max(score[0]) < 0.1


def test_counts_are_those_of_brute_force(spark):
    toxicity.ship(spark)
    rows, labels = corpus(200)
    toxic = {i: t for i, _, t in labels}
    training = spark.createDataFrame([(text, toxic[i]) for i, text in rows], "text string, toxic int").repartition(5)
    counts = toxicity._counts(training, 64, Scratch(spark, "test"))
    table = toxicity._word_table(counts)
    pairs = Counter()
    for i, text in rows:
        w = words(pa.array([text]), terms=True)[0].tolist()
        pairs.update((b, x, toxic[i]) for b, x in zip([0, *w], w))
    want = defaultdict(lambda: [0] * 7)
    for b, x in {(b, x) for b, x, _ in pairs}:
        want[x][0] += 1
    for (b, x, c), n in pairs.items():
        want[x][1 + c] += 1
        want[b][3 + c] += n
        want[b][5 + c] += 1
    assert {w: list(n) for w, *n in zip(table["words"].tolist(), *(table[k][:-1].tolist() for k in toxicity.WORD_COUNTS))} == dict(want)
    got = {}
    for r in counts.where("part < 0").collect():
        n = toxicity._loose(r["c"], np.int32).reshape(2, -1)
        got.update(zip(zip(toxicity._unpacked(bytes(r["a"])).tolist(), np.frombuffer(r["b"], np.uint64).tolist()), n.T.tolist()))
    assert got == {(b, x): [pairs[b, x, 0], pairs[b, x, 1]] for b, x, _ in pairs}


def test_only_rows_of_the_fit_are_kept_from_the_counts(spark, monkeypatch):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    assert 0.18 < ids.where(toxicity._fit_rows(20_000)).count() / 20_000 < 0.22
    monkeypatch.setattr(toxicity, "FIT_ROWS", 500)
    assert 400 < ids.where(toxicity._fit_rows(20_000)).count() < 600
    seen = []
    monkeypatch.setattr(toxicity, "_training", lambda texts, labels, f=toxicity._training: seen.append(labels.count()) or f(texts, labels))
    monkeypatch.setattr(toxicity, "FIT_ROWS", 20)
    rows, labels = corpus(400)
    toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    known = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _ in rows)
    assert known - 45 < seen[0] < known

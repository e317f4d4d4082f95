"""Decontamination against a search along all diagonals."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from arbor.llm import decontam

from .helpers import clashing, prose


def terms(t):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())


def brute(docs, items):
    out = set()
    where = defaultdict(list)
    own = {}
    for i, t in items:
        if i is not None:
            own[i] = terms(t)
            for j, w in enumerate(own[i]):
                where[w].append((i, j))
    for d, t in docs:
        if d is None:
            continue
        text, hits = terms(t), Counter()
        for p, w in enumerate(text):
            for i, j in where.get(w, ()):
                hits[i, p - j] += 1
        for (i, shift), n in hits.items():
            item = own[i]
            if len(item) < decontam.LEAST_ITEM and text != item:
                continue  # a whole text, or nothing
            a, b = max(0, -shift), min(len(item), len(text) - shift)
            start, stop, same = decontam.best_stretch(np.array([text[k + shift] == item[k] for k in range(a, b)]))
            if decontam.enough(same, stop - start, len(item)):
                out.add((d, i, a + start + shift, stop - start, same))
    return out


def case(seed=2):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice([6, 15, 30, 60]), 10**5)) for i in range(12)] + [
        (50, None), (51, ""), (52, "a b c"), (53, "Yes"), (None, prose(rng, 20)), (0, None)]
    items = [x for x in items if x != (0, None)]
    docs = []
    for d in range(60):
        text = prose(rng, rng.randrange(0, 120), 10**5).split()
        if d % 2:
            item = terms(rng.choice(items[:12])[1])
            for _ in range(rng.choice([0, 0, 1, 2])):  # substitutions, far apart
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() + "," if rng.random() < 0.3 else w for w in item]
        docs.append((d, " ".join(text)))
    copied = "so, " + max((t for _, t in items[:12]), key=len)
    docs += [(110, "A, b c!"), (111, "so a b c"), (112, "yes"), (113, "yes yes"), (114, "a b")]
    docs += [(100, None), (101, ""), (102, copied), (102, copied), (None, copied)]
    return docs, items


def test_overlaps_match_a_search_along_all_diagonals(spark):
    docs, items = case()
    got = {tuple(r) for r in decontam.overlaps(clashing(spark.createDataFrame(docs, "doc_id long, text string")),
                                               clashing(spark.createDataFrame(items, "item_id long, text string"))).collect()}
    want = brute(docs, items)
    assert got <= want
    # seeds find an overlap unless substitutions lie just so; with at most two of them in 15 terms or more, none hides
    assert {w for w in want if w[4] >= w[3] - 2 and w[3] >= 15} <= got
    assert {w for w in want if w[4] == w[3]} <= got
    assert any(w[4] < w[3] for w in got) and any(w[0] == 102 for w in got)
    assert {(w[0], w[1]) for w in got if w[1] in (52, 53)} == {(110, 52), (112, 53)}


def test_every_single_substitution_that_is_enough_is_found(spark):
    rng = random.Random(5)
    items, docs, want = [], [], set()
    for n in range(5, 15):
        items.append((n, " ".join(f"item{n}word{i}" for i in range(n))))
        for at in range(n):
            changed = items[-1][1].split()
            changed[at] = "changed"
            docs.append((100 * n + at, prose(rng, 9, 10**5) + " " + " ".join(changed) + " " + prose(rng, 7, 10**5)))
            start, stop, same = decontam.best_stretch(np.arange(n) != at)
            if decontam.enough(same, stop - start, n):
                want.add((100 * n + at, n, 9 + start, stop - start, same))
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {tuple(r) for r in got} == want and {w[1] for w in want} == set(range(5, 15))


def test_clean_documents_stay_and_columns_too(spark):
    docs, items = case()
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    hit = {r.doc_id for r in decontam.overlaps(df, bench).collect()}
    kept = decontam.decontaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == sorted(
        ((d, t) for d, t in docs if d is not None and d not in hit), key=lambda x: (x[0], x[1] or ""))
    assert sum(r.doc_id is None for r in kept.collect()) == 1


def test_empty_tables(spark):
    docs, items = case()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontam.overlaps(d.where("false"), b).collect() == []
    assert decontam.overlaps(d, b.where("false")).collect() == []


def test_long_document_with_the_item_at_its_end(spark):
    rng = random.Random(8)
    item = prose(rng, 25, 10**6)
    text = prose(rng, 200_000, 10**6) + " " + item
    got = decontam.overlaps(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                            spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(1, 7, 200_000, 25, 25)]


def test_masks_skip_their_gaps():
    a = np.arange(1, 14, dtype=np.uint64)
    b = a.copy()
    mask = decontam.MASKS[0]
    b[mask.index("0")] = 99
    assert decontam.seeds(a, mask)[0] == decontam.seeds(b, mask)[0]
    b[0] = 98
    assert decontam.seeds(a, mask)[0] != decontam.seeds(b, mask)[0]

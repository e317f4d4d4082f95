"""Quality: held-out accuracy, shrinkage of sites, edge cases."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from arbor.llm import quality

from .helpers import clashing

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    got = quality.classify(docs, labels.where(train)).join(labels.where(~train), "doc_id").collect()
    right = sum(r.keep == (r.quality == 1) for r in got) / len(got)
    lost = sum(r.quality == 1 and not r.keep for r in got)
    assert right >= 0.97 and lost <= 1


def corpus(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeiou") for _ in range(rng.randrange(2, 8)))
    good = lambda: " ".join(word() for _ in range(80)).capitalize() + "."
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(80))
    rows, labels, i = [], [], 0
    for host, share, n in (("good", 1.0, 120), ("bad", 0.02, 120), ("tiny", 0.0, 1)):
        for k in range(n):
            ok = k < share * n
            rows.append((i, good() if ok else bad(), "en", host, i))
            labels.append((i, int(ok), 0))
            i += 1
    rows += [(9000, None, "en", "good", 1), (9001, "", None, None, None), (9002, " \n", "en", "good", 1), (None, good(), "en", "good", 1),
             (0, rows[0][1], "en", "good", 1), (9003, " ".join(good() for _ in range(300)), "en", "good", 1)]
    labels += [(None, 1, 0), (3, None, None), (5, 1, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_posteriors_and_scores_are_those_of_plain_counts(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = [r for r in quality.classify(docs, labels).join(docs.select("doc_id", "text"), "doc_id").collect() if (r.text or "").strip()]
    paths, hosts = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for r in got:
        for site in (paths[r.host, r.path], hosts[r.host]):
            site[0] += 1
            site[1] += r.p_doc
    total = sum(n for n, _ in hosts.values())
    share = (sum(s for _, s in hosts.values()) + 0.5) / (total + 1)

    def weight(groups):
        n, n2 = sum(n for n, _, _ in groups), sum(n * n for n, _, _ in groups)
        if n - n2 / n <= 0:
            return 1e6
        q = sum(n * (s / n - p) ** 2 / (p * (1 - p)) for n, s, p in groups)
        return min(max(1 / max((q - (len(groups) - 1)) / (n - n2 / n), 1e-6) - 1, 1.0), 1e6)

    of_host = weight([(n, s, share) for n, s in hosts.values()])
    host_share = {h: (s + of_host * share) / (n + of_host) for h, (n, s) in hosts.items()}
    of_path = weight([(n, s, min(max(host_share[h], 1e-4), 1 - 1e-4)) for (h, _), (n, s) in paths.items()])
    logit = lambda p: math.log(p / (1 - p))
    for r in got:
        n, s = paths[r.host, r.path]
        path = (s + of_path * host_share[r.host] - r.p_doc) / (n + of_path - 1)
        path = min(max(path, 1e-4), 1 - 1e-4)
        shift = min(max(logit(path) - logit(share), -quality.MOST_SHIFT), quality.MOST_SHIFT)
        assert abs(r.host_share - host_share[r.host]) < 1e-9 and abs(r.path_share - path) < 1e-9
        score = 1 / (1 + (1 - r.p_doc) / r.p_doc * math.exp(-shift))
        assert abs(r.score - score) < 1e-6 and r.keep == (r.score >= quality.THRESHOLD)
    assert len(got) > 900 and len(paths) > len(hosts) > 1


def test_sites_shrink_toward_their_parents(spark):
    docs, labels = corpus(spark)
    got = quality.classify(clashing(docs), clashing(labels)).collect()
    share = {r.host: r.path_share for r in got}
    everywhere = share["good"] * 0.5 + share["bad"] * 0.5
    assert share["good"] > 0.9 and share["bad"] < 0.1
    assert share["bad"] < share["tiny"] < share["good"] and abs(share["tiny"] - everywhere) < 0.5
    by = {r.doc_id: r for r in got}
    assert not by[9000].keep and by[9000].score == 0 and not by[9001].keep and not by[9002].keep
    assert by[9003].keep and by[0].keep
    # a clean document of a poor site is kept on its own evidence
    assert by[120].host == "bad" and by[120].keep
    assert len(got) == docs.count()


def test_keep_good_keeps_rows_and_columns(spark):
    docs, labels = corpus(spark)
    df = clashing(docs)
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    want = sorted(r.doc_id for r in quality.classify(df, labels).where("keep AND doc_id IS NOT NULL").collect())
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert {r.score for r in kept.collect()} == {"extra score"}


@pytest.mark.parametrize("which", ["docs", "labels", "one class"])
def test_empty_tables_and_one_class(spark, which):
    docs, labels = corpus(spark)
    if which == "docs":
        assert quality.classify(docs.where("false"), labels).collect() == []
        assert quality.keep_good(docs.where("false"), labels).collect() == []
        return
    own = labels.where("false") if which == "labels" else labels.where("quality = 1")
    got = quality.classify(docs, own).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 for r in got)

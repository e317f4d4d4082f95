"""The pipeline's stages, each against what its operator (tested by itself) or brute force says of its own input."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from arbor.llm import quality

from . import test_decontam, test_jaccard, test_secret_scan
from .helpers import clashing, prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output over the small tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "bpe"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns


def test_quality_keeps_clean_documents(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = set(ids(after))
    assert kept == {r.doc_id for r in quality.classify(before, labels).where("keep").collect()}
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(clean - kept) <= 0.01 * len(clean)


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    want = test_jaccard.brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert ids(after) == sorted(i for i, (_, c) in want.items() if i == c)


def test_overlapping_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, *_ in test_decontam.brute([(r.doc_id, r.text) for r in before.collect()], items)}
    assert ids(after) == [i for i in ids(before) if i not in hit]


def test_secrets_are_replaced(stages):
    before, after = stages["secrets"]
    assert ids(before) == ids(after)
    was = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert not test_secret_scan.base(r.text)
        assert (r.text == was[r.doc_id]) == (not test_secret_scan.base(was[r.doc_id]) and not test_secret_scan.entropy(was[r.doc_id]))
        assert r.n_chars == len(r.text)


def test_last_stage_encodes(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert list(r.ids) == library.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_gives_the_last_stage(spark, stages):
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {r.doc_id: r.n_tokens for r in stages["bpe"][1].collect()}


def test_no_text_is_lost_with_its_id(spark):
    rng = random.Random(6)
    a, b, c = (prose(rng, 50, 10**6) for _ in range(3))
    rows = [(3, a), (7, a + " end"), (7, b), (8, c), (None, c), (None, "x " + b), (9, "unlike " + prose(rng, 50, 10**6)), (9, prose(rng, 50, 10**6))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()}
    assert kept == {rows[i] for i in (0, 2, 3, 6, 7)}


def test_odd_rows_pass_every_stage(spark):
    rng = random.Random(2)
    text = prose(rng, 60, 10**5)
    rows = [(1, text), (1, text), (2, text + " more"), (None, prose(rng, 60, 10**5)), (3, None), (4, ""), (5, "token=abcdef123 " + prose(rng, 60, 10**5)),
            (6, prose(rng, 30_000, 10**5))]
    docs = clashing(spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows],
                                          "doc_id long, text string, lang string, source string, n_chars int"))
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, 6, None], key=repr)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).collect() == [], name

"""BPE against the tokenizers library: ids, decoded texts, every assigned character, edge cases."""

from __future__ import annotations

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from arbor.llm import bpe

from .helpers import clashing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.Vocabulary.load(PATH))


def coded(coder, texts):
    flat, ends = coder.encode(texts)
    return [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


def same(coder, library, texts):
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = coded(coder, texts)
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
    assert [coder.decode(i) for i in got] == [library.decode(i, skip_special_tokens=False) for i in want]


def test_every_assigned_character_of_the_basic_plane(coder, library):
    own = [c for c in map(chr, range(1, 0x10000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    for a in range(0, len(own), 20000):
        same(coder, library, [f"a{c}B {c}{c} 1{c}" for c in own[a:a + 20000]])


def test_random_words_and_specials(coder, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCé' 12,.!\t\n") for _ in range(rng.choice([3, 20, 300]))) for _ in range(1500)]
    texts += ["", "  ", "don't I'LL 'S", "x<|endoftext|>y<|startoftext|> ", "<|EndOfText|>", "a\x1cb \x1c ΑΣ İ é é", "²½Ⅷ 😀👍🏽"]
    same(coder, library, texts)


def test_long_words_merge_alike(coder, library):
    same(coder, library, ["a" * 3000, "ab" * 3000, "the" * 100, "x" * 63, "x" * 64, "x" * 65, "thing" * 13 + " " + "Ü" * 200])


def test_memo_is_bounded_and_forgets(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    coder = bpe.Coder(bpe.Vocabulary.load(PATH))
    rng = random.Random(2)
    for _ in range(5):
        same(coder, library, ["".join(rng.choice("abcdef ") for _ in range(200))])


def test_rows_of_a_table(spark, library):
    texts = ["Hello, World!", None, "", "Hello, World!", "é " * 50_000, "one <|endoftext|> two"]
    df = clashing(spark.createDataFrame([(i if i != 3 else 0, t) for i, t in enumerate(texts)] + [(None, "x")], "doc_id long, text string"))
    want = []
    for i, t in [(0, texts[0]), (1, ""), (2, ""), (0, texts[3]), (4, texts[4]), (5, texts[5]), (None, "x")]:
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.digests(bpe.encode_decode(df, PATH)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    round_trip = {r.doc_id: r.decoded for r in bpe.decode(bpe.encode(df, PATH), PATH).collect()}
    assert round_trip[5] == "one</w> <|endoftext|> two</w>" and round_trip[1] == ""


def test_empty_table_and_unknown_ids(spark, coder):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    df = spark.createDataFrame([(1, None), (2, [-5, 320, 10**6])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(df, PATH).collect()} == {1: "", 2: "a</w>"}
    assert isinstance(coder.encode([])[0], np.ndarray)

"""Perspective rotation against a plain Python version."""

from __future__ import annotations

import re

from arbor.llm import chat

from .helpers import clashing

ROWS = [(1, 0, "system", "be kind"), (1, 1, "ann", "hello"), (1, 2, "bob", "hi é😀"), (1, 3, "ann", None), (1, 3, "ann", None),
        (2, 0, "system", "only"), (3, None, None, ""), (None, 1, "cat", "x" * 100_000), (None, 2, "dog", "y"), (4, 1, "user", "a"),
        (4, 1, "assistant", "b")]


def brute(rows):
    out = []
    turns = [(c, t, r if r is not None else "unknown", x or "") for c, t, r, x in rows]
    for c in {r[0] for r in turns}:
        own = [r for r in turns if r[0] == c]
        for p in {r[2] for r in own} - {"system"}:
            for _, t, s, x in own:
                as_role = "system" if s == "system" else "assistant" if s == p else "user"
                head = "<|im_start|>" + (f"user name={s}" if as_role == "user" else as_role) + "\n"
                learned = as_role == "assistant"
                out.append((c, p, t, s, as_role, head + x + "<|im_end|>\n", len(head) if learned else 0,
                            len(head) + len(x) + len("<|im_end|>") if learned else 0))
    return sorted(out, key=repr)


def test_rotation(spark):
    df = clashing(spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string"))
    got = chat.rotate(df)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)
    assert not re.search("Python|Arrow|Pandas", got._jdf.queryExecution().executedPlan().toString())


def test_whole_dialogues_and_their_masks(spark):
    df = spark.createDataFrame(ROWS[:4], "conv_id long, turn long, role string, text string")
    got = {r.perspective: r for r in chat.dialogues(chat.rotate(df)).collect()}
    assert set(got) == {"ann", "bob"}
    r = got["bob"]
    assert r.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhello<|im_end|>\n<|im_start|>assistant\nhi é😀")
    assert [r.text[m.start:m.stop] for m in r.masks] == ["hi é😀<|im_end|>"]
    assert [got["ann"].text[m.start:m.stop] for m in got["ann"].masks] == ["hello<|im_end|>", "<|im_end|>"]


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []

"""Small fixtures shared by the tests of the text operators."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

#: Names that operators use for their own columns, results or helpers.
CLASHING = ["n", "n_tokens", "ids", "decoded", "base", "added", "spans", "score", "keep", "host", "path", "cell", "f", "z", "words",
            "held_out", "predicted", "component_id", "n_shingles", "rep", "gid", "bits", "_secrets", "_in_0", "_id", "_found", "rank",
            "perspective", "speaker", "segment", "rule", "verdict", "n_chars", "run", "toxic", "quality", "at", "hash", "v", "x", "dims"]


def clashing(df):
    """``df`` with extra columns named like the operators' own."""
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING if c not in df.columns])


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

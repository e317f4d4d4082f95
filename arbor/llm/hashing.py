"""Word hashes straight from Arrow string buffers, and sets of word shingles, in numpy.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased. A
word's hash is a polynomial over random byte weights, taken from running sums,
so a slice of documents costs a few array passes and no Python loop per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.default_rng(20260101)
_WEIGHT = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_WEIGHT[65:91] = _WEIGHT[97:123]  # A-Z as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_IS_MARK = np.ones(256, bool)  # ASCII other than letters and digits separates terms
_IS_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BASE = U(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64 (kept for the next slice)."""
    if len(_POWERS["p"]) < n:
        size = max(n, 1 << 16)
        for key, base in (("p", int(_BASE)), ("q", pow(int(_BASE), -1, 2**64))):
            out = np.full(size, U(base))
            out[0] = 1
            _POWERS[key] = np.cumprod(out, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def string_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the row offsets into them (null rows are empty)."""
    n = len(col)
    width = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offsets = np.frombuffer(col.buffers()[1], dtype=width)[col.offset:col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words(col: pa.Array, terms: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of texts: word hashes, row ends in words (starting with 0), and each word's byte start and end.

    With ``terms``, every ASCII character but letters and digits separates, and
    Latin-1 capitals are lower-cased too, so case and punctuation don't count.
    """
    raw, offsets = string_buffer(col)
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    if terms:
        capital = (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
        capital[1:] &= raw[:-1] == 0xC3
        capital[0] = False
        raw = raw + (capital * np.uint8(0x20))
    word = ~(_IS_MARK if terms else _IS_SPACE)[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | cut[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | cut[1:n]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _powers(n)
    total = np.cumsum(_WEIGHT[raw] * power, dtype=np.uint64)
    before = np.where(start > 0, total[start - 1], U(0))
    value = mix((total[stop - 1] - before) * inverse[start] + (stop - start).astype(np.uint64))
    return value, np.searchsorted(start, offsets), start, stop


_STEP = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93),
         U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3), U(0x589965CC75374CC3)]


def _step(i: int) -> U:
    return _STEP[i % len(_STEP)] if i < len(_STEP) else U((int(_STEP[i % len(_STEP)]) * (2 * i + 1)) % 2**64)


def ngrams(value: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (across rows: the caller drops those)."""
    n = max(len(value) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += value[i:i + n] * _step(i)
    return mix(out)


def shingle_sets(col: pa.Array, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``k``-word shingles; fewer words: the whole sequence as one; none: empty."""
    value, ends, _, _ = words(col)
    grams = ngrams(value, k)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            out.append(ngrams(value[a:b], b - a) ^ U(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out

"""BPE encoding and decoding of whole documents (operator 4).

Method: contiguous rank array. A word is an array of part ids and an array of
the ranks of its adjacent pairs. The leftmost smallest rank is found by a scan,
its boundary is deleted, and the ranks of the two neighbours are refreshed,
until no pair has a rank. Words of equal width class are held as rows of one
matrix, so a scan, a deletion and a refresh serve thousands of words at once.
Words past ``SHORT`` parts keep the same rule with a heap in place of the scan,
which would take quadratic time there.

Only new white-space-separated chunks are normalised, split and merged; a
bounded per-process memo answers the rest. Text is normalised as the vocabulary
file says: NFC, lower case by character, white space separates.

Defined cases: null or empty text gives no ids and an empty decoded text;
repeated rows give repeated results; other columns of the input are ignored
(:func:`encode` returns just its own); special tokens in a text become their
own ids; unknown ids decode to nothing.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, map_text, ship, texts_of

#: Widths of the word matrices; longer words use a heap.
WIDTHS = (4, 8, 16, 32, 64)
SHORT = WIDTHS[-1]
#: Chunks and words kept per Python process (memory, not results).
MEMO = 200_000
#: Text bytes coded at once: new words of a slice are merged together.
SLICE = 4 << 20
NO_RANK = np.int32(2**31 - 1)

@lru_cache(maxsize=None)
def category(first: str) -> str:
    """The code points whose general category starts with ``first``, as the inside of a character class."""
    own = np.array([unicodedata.category(chr(i))[0] == first for i in range(0x110000)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


@lru_cache(maxsize=None)
def word_pattern() -> re.Pattern:
    # The split pattern of the vocabulary file, without its white-space part, as chunks hold none.
    letters, numbers = category("L"), category("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}]+")


# Controls that str.split() takes as white space and the vocabulary's pattern does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACE = re.compile(r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 characters for themselves, the rest from U+0100 on."""
    own = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A word-end BPE vocabulary as arrays (its size is that of the vocabulary file)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE vocabulary without unknown token is needed")
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {}
        for t in spec["added_tokens"]:
            self.tokens[t["id"]] = t["content"]
            self.special[t["content"]] = t["id"]
        letters = byte_alphabet()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        keys, merged = [], []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            keys.append(vocab[a] << 32 | vocab[b])
            merged.append(vocab[a + b])
        self.merged = np.array([*merged, 0], np.int32)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(2**62))
        self.key_rank = np.append(order.astype(np.int32), NO_RANK)

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; ``NO_RANK`` where it never merges."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.key_rank[at], NO_RANK)


def merge_rows(v: Vocabulary, parts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row of ``parts`` (first ``size`` entries used) by the contiguous rank array."""
    n, width = parts.shape
    out, out_size = parts.copy(), size.copy()
    if width < 2:
        return out, out_size
    rank = v.ranks(parts[:, :-1], parts[:, 1:])
    rank[np.arange(width - 1)[None, :] >= (size - 1)[:, None]] = NO_RANK
    row, parts, size = np.arange(n), parts.copy(), size.copy()
    cols = np.arange(width)[None, :]
    while len(row):
        at = rank.argmin(axis=1)
        here = np.arange(len(row))
        low = rank[here, at]
        open_ = low < NO_RANK
        if not open_.all():
            done = ~open_
            out[row[done]], out_size[row[done]] = parts[done], size[done]
            row, parts, rank, size, at, low = row[open_], parts[open_], rank[open_], size[open_], at[open_], low[open_]
            if not len(row):
                break
            here = np.arange(len(row))
        # delete the boundary after ``at``: later parts and ranks move left by one
        parts = np.take_along_axis(parts, np.minimum(cols + (cols > at[:, None]), width - 1), axis=1)
        parts[here, at] = v.merged[low]
        size -= 1
        rank = np.take_along_axis(rank, np.minimum(cols[:, :-1] + (cols[:, :-1] >= at[:, None]), width - 2), axis=1)
        rank[here, np.minimum(size - 1, width - 2)] = NO_RANK  # the pair that fell off the end
        right = at + 1 < size
        r = here[right]
        rank[r, at[right]] = v.ranks(parts[r, at[right]], parts[r, at[right] + 1])
        left = at > 0
        r = here[left]
        rank[r, at[left] - 1] = v.ranks(parts[r, at[left] - 1], parts[r, at[left]])
    return out, out_size


def merge_long(v: Vocabulary, parts: list[int]) -> list[int]:
    """The same merges for one long word: smallest rank first, leftmost among equals, by a heap."""
    n = len(parts)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    ranks = v.ranks(np.array(parts[:-1]), np.array(parts[1:]))
    heap = [(int(r), i, parts[i], parts[i + 1]) for i, r in enumerate(ranks) if r < NO_RANK]
    heapq.heapify(heap)
    alive = [True] * n

    def push(i: int, j: int) -> None:
        r = int(v.ranks(np.array([parts[i]]), np.array([parts[j]]))[0])
        if r < NO_RANK:
            heapq.heappush(heap, (r, i, parts[i], parts[j]))

    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j], after[i] = int(v.merged[r]), False, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            push(i, after[i])
        if before[i] >= 0:
            push(before[i], i)
    return [p for p, a in zip(parts, alive) if a]


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[start:start + size]`` of the entries ``at``, one after the other, and their sizes."""
    n = size[at]
    shift = np.repeat(start[at] - (np.cumsum(n) - n), n)
    return flat[shift + np.arange(len(shift))], n


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word (its UTF-8 bytes), one word after the other, and how many each has."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    count = np.zeros(len(words), np.int64)
    parts_of, order, below = [], [], 0
    for width in WIDTHS:
        own = np.flatnonzero((size > below) & (size <= width))
        below = width
        if not len(own):
            continue
        n = size[own]
        raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in own.tolist()), np.uint8)
        raw = raw.reshape(len(own), width)
        parts = v.inner[raw]
        parts[np.arange(len(own)), n - 1] = v.last[raw[np.arange(len(own)), n - 1]]
        done, done_size = merge_rows(v, parts, n)
        parts_of.append(done[np.arange(width)[None, :] < done_size[:, None]])
        order.append(own)
        count[own] = done_size
    for i in np.flatnonzero(size > SHORT).tolist():
        raw = np.frombuffer(words[i], np.uint8)
        parts = v.inner[raw]
        parts[-1] = v.last[raw[-1]]
        ids = np.array(merge_long(v, parts.tolist()), np.int32)
        parts_of.append(ids)
        order.append(np.array([i]))
        count[i] = len(ids)
    if not order:
        return np.zeros(0, np.int32), count
    flat, own = np.concatenate(parts_of), np.concatenate(order)
    start = np.zeros(len(words), np.int64)
    start[own] = np.cumsum(count[own]) - count[own]
    return gather(flat, start, count, np.arange(len(words)))[0], count


class Coder:
    """Encodes and decodes texts with a vocabulary; keeps a bounded memo of words and white-space-separated chunks."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.special = re.compile("(" + "|".join(map(re.escape, v.special)) + ")") if v.special else None
        self.forget()

    def forget(self) -> None:
        """An empty memo: entries are runs of ``flat``; special tokens are there from the start."""
        self.flat = np.array(list(self.v.special.values()), np.int32)
        self.start, self.size = np.arange(len(self.flat)), np.ones(len(self.flat), np.int64)
        self.memo: dict[str, int] = {t: k for k, t in enumerate(self.v.special)}

    def _add(self, keys: list[str], flat: np.ndarray, size: np.ndarray) -> None:
        self.memo.update(zip(keys, range(len(self.start), len(self.start) + len(keys))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat])

    def _learn(self, missing: list[str]) -> None:
        """Add new chunks to the memo (none holds white space, so they can be normalised in one go)."""
        if not missing:
            return
        memo, find, special = self.memo, word_pattern().findall, self.special
        # capital sigma by itself: str.lower() would look at its neighbours
        plain = unicodedata.normalize("NFC", "\n".join(missing)).replace("Σ", "σ").lower().split("\n")
        several: dict[str, list[str]] = {}
        same: dict[str, str] = {}
        for raw, chunk in zip(missing, plain):
            if chunk.isalpha():
                same[raw] = chunk
            elif special and special.search(raw):
                own: list[str] = []
                for part in special.split(raw):
                    own += [part] if part in self.v.special else find(
                        unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
                several[raw] = own
            else:
                several[raw] = find(chunk)
        todo = [w for w in {*same.values(), *chain.from_iterable(several.values())} if w not in memo]
        self._add(todo, *merge_words(self.v, [w.encode() for w in todo]))
        memo.update((raw, memo[w]) for raw, w in same.items())
        several = {raw: own for raw, own in several.items() if raw not in memo}
        if several:
            at = np.fromiter(map(memo.__getitem__, chain.from_iterable(several.values())), np.int64)
            words = np.fromiter(map(len, several.values()), np.int64, len(several))
            flat, n = gather(self.flat, self.start, self.size, at)
            ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(words)]
            self._add(list(several), flat, np.diff(ends, prepend=0))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the ends of the texts (starting with 0)."""
        split = [list(filter(None, SPACE.split(t))) if any(c in t for c in SEPARATORS) else t.split() for t in texts]
        if len(self.memo) > MEMO:
            self.forget()
        seen: set[str] = set().union(*split)
        self._learn([c for c in seen if c not in self.memo])
        lens = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(split)), np.int64)
        flat, n = gather(self.flat, self.start, self.size, at)
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(lens)])]
        return flat, ends

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by a space (the vocabulary file has no decoder); unknown ids are left out."""
        tokens, n = self.v.tokens, len(self.v.tokens)
        if ids and (min(ids) < 0 or max(ids) >= n):
            ids = [i for i in ids if 0 <= i < n]
        return " ".join(map(tokens.__getitem__, ids))


_CODERS: dict[str, Coder] = {}


def _coder(key: str, shared) -> Coder:
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(shared.value)
    return _CODERS[key]


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, ids`` of every whole text. The vocabulary is a file of fixed size, read once and broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))

    def run(batch: pa.RecordBatch) -> dict:
        flat, ends = _coder(vocabulary_path, shared).encode(texts_of(batch))
        return {"doc_id": batch.column("doc_id"), "ids": _lists(flat, ends)}

    return map_text(id_text(docs), "text", run, "doc_id long, ids array<int>", SLICE)


def encode_decode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, ids, decoded``: each text's ids and the text decoded from those ids, in one pass over the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))

    def run(batch: pa.RecordBatch) -> dict:
        coder = _coder(vocabulary_path, shared)
        flat, ends = coder.encode(texts_of(batch))
        ids = flat.tolist()
        return {"doc_id": batch.column("doc_id"), "ids": _lists(flat, ends),
                "decoded": [coder.decode(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]}

    return map_text(id_text(docs), "text", run, "doc_id long, ids array<int>, decoded string", SLICE)


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, decoded`` from ``doc_id, ids``; null ids decode to the empty text."""
    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))

    def run(batches):
        coder = _coder(vocabulary_path, shared)
        for batch in batches:
            texts = [coder.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of :func:`encode_decode`'s rows."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

"""Importance resampling towards a target distribution, with n-grams hashed from prefix CRCs (operator 13).

A document's features are its runs of 1 to ``most`` words; a feature's bucket is the
CRC-32 of its words, joined by one space, modulo ``buckets``. A document is read once: its
words, each with a space before it, feed one running CRC, and the state after every word
is kept. With A the text before an n-gram and B the n-gram, ``crc(AB)`` is ``crc(A)``
moved on by as many zero bytes as B has, xor ``crc(B)``; so any n-gram's CRC comes from
two stored states, and the move, a linear map over GF(2), cancels what stood before.
Maps for up to ``SHORT`` bytes are tables; longer ones are put together from the maps
for powers of two.

Bucket counts of the whole corpus and of all target texts give each bucket a gain; a
document's weight is the floored mean gain of its features, and its score adds Gumbel
noise from its id, so the highest scores are a sample without replacement. Documents
are ranked by range partitions and running sums; nothing is sorted in one task.

What goes to every task are ``buckets`` gains. What comes to the driver are ``buckets``
counts and, for ranking, one row for each partition.

Defined cases: null or empty texts have no features and weight 0; without target texts
(or an empty corpus) the gains come from the added ones alone; a document without an id
has no score and is not counted among those to draw from; rows with the same id are
documents of their own with the same noise, ranked by features and weight; very long
texts are read whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_text, ship, slices
from .running import running_sums

#: Lengths in bytes whose shift has a table of its own.
SHORT = 64
#: Text bytes worked on at once: the arrays hold a few dozen bytes for each word.
SLICE = 1 << 20

# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    """What each low byte of a CRC state becomes when one byte moves it out."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(POLYNOMIAL), t >> 1)
    return t


_BYTE = _byte_table()


def _apply(maps: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as four tables of 256, on an array."""
    return maps[0][x & 255] ^ maps[1][x >> 8 & 255] ^ maps[2][x >> 16 & 255] ^ maps[3][x >> 24]


def _moved(x: np.ndarray) -> np.ndarray:
    """States moved on by one zero byte."""
    return x >> 8 ^ _BYTE[x & 255]


_IDENTITY = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])


def _short_maps() -> np.ndarray:
    """``[byte of the state, length, value]``: the maps for 0 to ``SHORT - 1`` zero bytes."""
    out = [_IDENTITY]
    for _ in range(SHORT - 1):
        out.append(_moved(out[-1]))
    return np.ascontiguousarray(np.stack(out).transpose(1, 0, 2)).reshape(4, -1)


_SHORT_MAPS = _short_maps()


def _power_maps() -> list[np.ndarray]:
    """The maps for 1, 2, 4, ... zero bytes, up to 2**31."""
    out = [_moved(_IDENTITY)]
    while len(out) < 32:
        out.append(_apply(out[-1], out[-1]))
    return out


_POWER_MAPS = _power_maps()


def shifted(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each state moved on by its own number of zero bytes."""
    short = length < SHORT
    at = np.where(short, length, 0).astype(np.int64) * 256
    out = _SHORT_MAPS[0][at + (state & 255)] ^ _SHORT_MAPS[1][at + (state >> 8 & 255)] \
        ^ _SHORT_MAPS[2][at + (state >> 16 & 255)] ^ _SHORT_MAPS[3][at + (state >> 24)]
    if not short.all():
        rest = np.flatnonzero(~short)
        x, n = state[rest], length[rest]
        for bit in range(int(n.max()).bit_length()):
            own = np.flatnonzero(n >> bit & 1)
            x[own] = _apply(_POWER_MAPS[bit], x[own])
        out[rest] = x
    return out


def _spaced() -> bytes:
    """Byte by byte: A-Z lower-cased; ASCII that is no letter or digit becomes a space."""
    keep = {*range(48, 58), *range(97, 123), *range(128, 256)}
    return bytes(c + 32 if 65 <= c <= 90 else c if c in keep else 32 for c in range(256))


_SPACED = _spaced()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_SPACED).split()


def prefix_states(words: list[bytes]) -> list[int]:
    """The running CRC after each word of the text in which every word has one space before it."""
    return list(accumulate(words, lambda crc, word: crc32(word, crc32(b" ", crc)), initial=0))[1:]


def ngram_crcs(state: np.ndarray, length: np.ndarray, follows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """CRCs of the runs of ``n`` words and the place of each run's first word.

    ``state`` and ``length`` (bytes) belong to the words of several documents;
    ``follows`` is false at a document's first word.
    """
    first = np.arange(len(state) - n + 1) if len(state) >= n else np.zeros(0, np.int64)
    for i in range(1, n):
        first = first[follows[first + i]]
    before = np.concatenate([np.zeros(1, np.uint32), state])[:len(state)]
    before = np.where(follows, before, np.uint32(0))
    # the state once the run's leading space is in: one byte fed into the state after the word before
    before = ~_moved(~before ^ np.uint32(32))
    ends = np.concatenate([[0], np.cumsum(length + 1)])
    size = ends[first + n] - ends[first] - 1
    return state[first + n - 1] ^ shifted(before[first], size), first


def _features(batch: pa.RecordBatch, buckets: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of texts: words of each row, and the bucket and the row of every feature."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    states, lengths, counts = [], [], []
    for text in texts:
        words = words_of(text) if text else []
        states += prefix_states(words)
        lengths += map(len, words)
        counts.append(len(words))
    n = np.array(counts, np.int64)
    state, length = np.array(states, np.uint32), np.array(lengths, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    follows = np.ones(len(row), bool)
    follows[(np.cumsum(n) - n)[n > 0]] = False
    parts = [ngram_crcs(state, length, follows, k) for k in range(1, most + 1)]
    return n, np.concatenate([c % np.uint32(buckets) for c, _ in parts]).astype(np.int64), np.concatenate([row[f] for _, f in parts])


def bucket_counts(texts: DataFrame, buckets: int, most: int) -> np.ndarray:
    """Features of all texts by bucket; a task sends its counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text", SLICE):
            _, bucket, _ = _features(part, buckets, most)
            total += np.bincount(bucket, minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log-ratio of a bucket's share in the target to that in the corpus, rounded down."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, target: DataFrame, buckets: int = 10_000, most: int = 2, id_col: str = "doc_id",
             text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""
    ship(docs.sparkSession)
    texts = id_text(docs, id_col, text_col)
    gains = gains_of(bucket_counts(texts, buckets, most),
                     bucket_counts(target.select(F.col(target_col).cast("string").alias("text")), buckets, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            n, bucket, row = _features(part, buckets, most)
            count = np.bincount(row, minlength=len(n))
            total = np.bincount(row, weights=gains[bucket], minlength=len(n)).astype(np.int64)  # whole numbers far below 2**53
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(count), pa.array(total // np.maximum(count, 1))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return texts.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that an id and a seed fix, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7,
             buckets: int = 10_000, most: int = 2) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null where it is not drawn."""
    scratch = Scratch(docs.sparkSession, "importance")
    scored = weighted(docs, target, buckets, most).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = scratch.write(scored, "scored")
    may = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()  # never null
    chosen = scored.where(may).select("doc_id", "n_features", "weight", "score", F.lit(0).cast("long").alias("all"), F.lit(1).cast("long").alias("rank"))
    drawn = chosen.count() * percent // 100
    ranked = running_sums(chosen, "all", [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("weight")], ["rank"], scratch, "ranked")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(~may)
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank")).unionByName(
        rest.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))

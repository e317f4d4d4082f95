"""Toxicity by class-conditional Kneser-Ney language models (operator 10).

Two models over words, one of toxic and one of ordinary training documents, are
compared word by word at two orders. At the first, a word counts by how many
different words it follows within the class, less a discount, and backs off to
the same count over both classes (and a uniform part). At the second, word pairs
of the class, less a discount, back off to the pairs of both classes, and these
to the common count. So an expression that is rare in one class gets that class's
share of the common backoff, not zero, and a pair that only one class happens to
have weighs little.

A document's log-likelihoods are normalised by its length: the features are the
mean log-ratio per word at each order, and the shares of words whose first-order
ratio passes fixed levels. A logistic regression turns them into a score. It is
fitted on training rows that the models did not see: a fifth, by hash, or about
``FIT_ROWS`` where a fifth is more. Counts come from every other training row.

Words are terms (case and punctuation don't count) under their 64-bit hash, and
so are pairs, so what is counted grows with the input and nothing shares a count.
Tasks count the pairs of a block of documents and send them to buckets by the
pair's hash; buckets sum them and count different neighbours; both are written.
The word table (every different training word) is broadcast to the tasks. Pairs
stay in their buckets: a block sends its different pairs there, and the bucket
returns, per document, the sum of what the pairs that training had add to the
second order. That sum is kept in whole ``1 / UNIT``, so it does not depend on
the order of addition.

Defined cases: null or empty texts score the training share of toxic rows;
labels that are null are no labels, and a document labelled twice is toxic if
one label says so; without toxic (or without ordinary) training rows every score
is that share; rows with the same id are scored each by its own text; rows
without an id are not held out and never train; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_text, map_text, ship, slices
from .hashing import U, mix, words

#: log2 of the words that a task counts or scores at once, and of the input words that make up a bucket of pairs.
WORD_BITS, PAIR_BITS = 18, 21
#: Documents of a block at most (their places fit 16 bits), and characters taken for a word when buckets are planned.
BLOCK_ROWS, WORD_CHARS = 1 << 13, 6
#: Discounts for counts of one, two, and three or more; the one for pairs.
DISCOUNT, PAIR_DISCOUNT = (0.95, 1.5, 2.0), 0.75
#: Levels of the log-ratio whose shares of words are features (the square root spreads small shares).
LEVELS = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)
#: Bound of the rows that the logistic regression is fitted on, and of its filter of labelled ids (log2 of bits).
FIT_ROWS, FILTER_BITS = 50_000, 23
#: Buckets of word pairs at least, and parts of the word table at most.
LEAST_BUCKETS, MOST_PARTS = 64, 256
#: Steps to one of the second order's sums, and rounds that documents are scored in (one round's shuffle is on disk at a time).
UNIT, ROUNDS = 1 << 20, 4
#: While tables are written: shuffle files go at the query's end, the tables are packed tighter than by default (what is counted
#: stands beside its shuffle), and Arrow batches stay small, as packed rows are long.
_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd",
             "spark.sql.execution.arrow.maxRecordsPerBatch": "64", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: Columns of the word table: words followed over both classes; by class words followed, pairs after it, different ones.
WORD_COUNTS = ("shared", "followed0", "followed1", "history0", "history1", "follows0", "follows1")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _kept(spark, ids: DataFrame):
    """A broadcast bit table of ids, of fixed size (it may let other ids through), and the SQL for an id's place."""
    cell = f"pmod(xxhash64(doc_id), {1 << FILTER_BITS})"
    rows = ids.groupBy(F.expr(f"bitmap_bucket_number({cell} + 1)").alias("at")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({cell} + 1))").alias("bits")).collect()
    table = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for r in rows:
        own = np.frombuffer(r["bits"], np.uint8)
        table[(r["at"] - 1) * 4096:(r["at"] - 1) * 4096 + len(own)] = own
    return spark.sparkContext.broadcast(table), cell


def _training(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of the labelled rows."""
    shared, cell = _kept(texts.sparkSession, labels)

    def run(batch: pa.RecordBatch) -> dict | None:
        at = batch.column("cell").to_numpy()
        own = np.flatnonzero(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        if not len(own):
            return None
        part = batch.take(pa.array(own))
        return {"doc_id": part.column("doc_id"), "text": part.column("text")}

    rows = texts.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).withColumn("cell", F.expr(cell))
    return map_text(rows, "text", run, "doc_id long, text string").join(labels, "doc_id").select("text", "toxic")


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of documents: the rows without texts, word hashes, the word before each (0: the start), row ends in words."""
    held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []

    def block():
        w = np.concatenate([v for _, v, _ in held])
        n = np.concatenate([np.diff(e) for _, _, e in held])
        ends = np.cumsum([0, *n])
        before = np.concatenate([np.zeros(1, np.uint64), w[:-1]])[:len(w)]
        before[ends[:-1][n > 0]] = 0
        return pa.Table.from_batches([r for r, _, _ in held]), w, before, ends

    for part in slices(batches, "text"):
        for at in range(0, part.num_rows, BLOCK_ROWS):
            rows = part.slice(at, BLOCK_ROWS)
            value, ends, _, _ = words(rows.column("text"), terms=True)
            if held and (sum(len(v) for _, v, _ in held) + len(value) > 1 << WORD_BITS
                         or sum(r.num_rows for r, _, _ in held) + rows.num_rows > BLOCK_ROWS):
                yield block()
                held = []
            held.append((rows.select([column]), value, ends))
    if held:
        yield block()


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * U(0x9E3779B97F4A7C15) + word)


def share_of(key: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges of hashes a hash is in."""
    return ((key >> U(32)) * U(n) >> U(32)).astype(np.int32)


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers byte by byte, so that bytes that are alike stand together, in zstd; their size in bytes comes first."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _loose(b: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(b[:8], "little")
    planes = pa.decompress(b[8:], decompressed_size=size, codec="zstd") if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed(x: np.ndarray) -> bytes:
    """Ascending hashes as differences."""
    return _squeezed(np.diff(x, prepend=U(0)))


def _unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(_loose(b, np.uint64), dtype=np.uint64)


def _cuts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _summed(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys in order, and the sums of the columns."""
    by = np.argsort(key, kind="stable")
    key = key[by]
    cuts = _cuts(key)
    return key[cuts], *(np.add.reduceat(c[by], cuts) if len(cuts) else c for c in columns)


def _bytes(table: pa.Table, name: str) -> list[bytes]:
    return [b for b in table.column(name).to_pylist() if b is not None]


#: Rows of a bucket: its pairs and what they add (kind 0), a block's pairs (kind 1), and a block's documents, which only pass (kind 2).
_ROW = "bucket int, kind int, block long, ids array<long>, a binary, b binary, c binary"


def _written(scratch: Scratch, df: DataFrame, tag: str) -> DataFrame:
    """``scratch.write`` under ``_SETTINGS``."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in _SETTINGS}
    try:
        for k, v in _SETTINGS.items():
            conf.set(k, v)
        return scratch.write(df, tag)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def _counts(training: DataFrame, buckets: int, scratch: Scratch) -> DataFrame:
    """Written counts: per bucket its pairs (``part`` -1) and, by parts of the word table, what they add to its counts."""
    parts = min(buckets, MOST_PARTS)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, w, before, ends in _blocks(batches, "toxic"):
            toxic = np.repeat(rows.column("toxic").to_numpy().astype(np.int64), np.diff(ends))
            key = pair_key(before, w)
            by = np.argsort(key, kind="stable")
            cuts = _cuts(key[by])
            if not len(cuts):
                continue
            n, t = np.diff(np.append(cuts, len(key))), np.add.reduceat(toxic[by], cuts)
            b, w, bucket = before[by][cuts], w[by][cuts], share_of(key[by][cuts], buckets)
            order = np.lexsort((b, bucket))
            b, w, n, t, bucket = b[order], w[order], n[order], t[order], bucket[order]
            starts = _cuts(bucket)
            for x, y in zip(starts, np.append(starts[1:], len(bucket))):
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket[x]], pa.int32()), "a": [_packed(b[x:y])], "b": [w[x:y].tobytes()],
                    "c": [_squeezed(np.concatenate([n[x:y] - t[x:y], t[x:y]]).astype(np.int32))]})

    def count(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        b = np.concatenate([_unpacked(x) for x in _bytes(rows, "a")])
        w = np.concatenate([np.frombuffer(x, np.uint64) for x in _bytes(rows, "b")])
        n = np.concatenate([_loose(x, np.int32).reshape(2, -1) for x in _bytes(rows, "c")], axis=1)
        by = np.lexsort((w, b))
        b, w, n = b[by], w[by], n[:, by]
        del by
        cuts = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (w[1:] != w[:-1])]))
        b, w, n = b[cuts], w[cuts], np.add.reduceat(n, cuts, axis=1, dtype=np.int64)
        del cuts
        # as the word before: pairs are in its order; as the word after: one more order, and a column at a time
        after, before = np.argsort(w, kind="stable"), _cuts(b)
        starts = _cuts(w[after])
        found = w[after][starts]
        followed = [np.diff(np.append(starts, len(w))), *(np.add.reduceat(c[after] > 0, starts, dtype=np.int64) for c in n)]
        led = [*(np.add.reduceat(c, before) for c in n), *(np.add.reduceat(c > 0, before, dtype=np.int64) for c in n)]
        none = [np.zeros(k, np.int64) for k in (len(found), len(before))]
        word, *sums = _summed(np.concatenate([found, b[before]]),
                              *(np.concatenate([c, none[1]]) for c in followed), *(np.concatenate([none[0], c]) for c in led))
        part = share_of(word, parts)
        starts = _cuts(part)
        out = [(bucket, -1, _packed(b), w.tobytes(), _squeezed(np.minimum(n, 2**31 - 1).astype(np.int32).ravel()))]
        out += [(bucket, int(part[x]), _packed(word[x:y]), _squeezed(np.minimum(np.concatenate([c[x:y] for c in sums]), 2**31 - 1).astype(np.int32)), None)
                for x, y in zip(starts, np.append(starts[1:], len(part)))]
        return pa.table(dict(zip(("bucket", "part", "a", "b", "c"), map(list, zip(*out)))), schema=pa.schema(
            [("bucket", pa.int32()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())]))

    sent = training.mapInArrow(spread, "bucket int, a binary, b binary, c binary")
    whole = sent.groupBy("bucket").applyInArrow(count, "bucket int, part int, a binary, b binary, c binary")
    return _written(scratch, whole, "counts")


def _word_table(counts: DataFrame) -> dict[str, np.ndarray]:
    """The different training words in order, and their counts; the last row stands for every other word."""
    width = len(WORD_COUNTS)

    def add(rows: pa.Table) -> pa.Table:
        word = np.concatenate([_unpacked(x) for x in _bytes(rows, "a")])
        by = np.argsort(word, kind="stable")
        word = word[by]
        cuts = _cuts(word)
        word = word[cuts]
        each = [_loose(x, np.int32).reshape(width, -1) for x in _bytes(rows, "b")]
        # a column at a time: buckets repeat most words
        sums = [np.add.reduceat(np.concatenate([x[i] for x in each])[by], cuts, dtype=np.int64) for i in range(width)]
        return pa.table({"part": pa.array([rows.column("part")[0].as_py()], pa.int32()), "a": pa.array([_packed(word)], pa.binary()),
                         "b": pa.array([np.minimum(np.stack(sums), 2**31 - 1).astype(np.int32).tobytes()], pa.binary())})

    whole = counts.where("part >= 0").select("part", "a", "b").groupBy("part").applyInArrow(add, "part int, a binary, b binary")
    got = sorted(((r["part"], bytes(r["a"]), bytes(r["b"])) for r in whole.toLocalIterator()), key=lambda r: r[0])
    word = np.concatenate([np.zeros(0, np.uint64), *(_unpacked(a) for _, a, _ in got)])
    sums = np.concatenate([*(np.frombuffer(b, np.int32).reshape(width, -1) for _, _, b in got), np.zeros((width, 1), np.int32)], axis=1)
    return {"words": word, **dict(zip(WORD_COUNTS, sums))}


def _discount(n: np.ndarray) -> np.ndarray:
    return np.where(n >= 3, DISCOUNT[2], np.where(n == 2, DISCOUNT[1], np.where(n == 1, DISCOUNT[0], 0.0))).astype(np.float32)


class Models:
    """The two models, and that of both classes together: what they hold by word. Pairs are given with their counts."""

    def __init__(self, t: dict[str, np.ndarray]):
        common = t["shared"].astype(np.float64) + 0.5
        common /= common.sum()
        self.words = t.get("words", np.zeros(0, np.uint64))
        self.common = common.astype(np.float32)
        word = []
        for c in (0, 1):
            kinds = t[f"followed{c}"]
            total, taken = max(float(kinds.sum(dtype=np.float64)), 1.0), _discount(kinds)
            word.append((kinds - taken) / total + taken.sum(dtype=np.float64) / total * common if kinds.any() else common)
        self.first = (np.log(word[1]) - np.log(word[0])).astype(np.float32)
        # pairs of a history and the share that it leaves to the backoff: ordinary, toxic, both
        self.history = [t["history0"], t["history1"], t["history0"].astype(np.int64) + t["history1"]]
        follows = [t["follows0"], t["follows1"], t["follows0"].astype(np.int64) + t["follows1"]]
        self.rest = [np.where(n > 0, np.minimum(f * np.float32(PAIR_DISCOUNT) / np.maximum(n, 1), 1.0), 1.0).astype(np.float32)
                     for f, n in zip(follows, self.history)]

    def at(self, w: np.ndarray) -> np.ndarray:
        """The words' rows; the last row for words that training has not."""
        if not len(self.words):
            return np.zeros(len(w), np.int64)
        some, back = np.unique(w, return_inverse=True)
        row = np.searchsorted(self.words, some)
        return np.where(self.words[np.minimum(row, len(self.words) - 1)] == some, row, len(self.words))[back]

    def alone(self, before: np.ndarray) -> np.ndarray:
        """Second-order log-ratio of a word after this one (by row) if training has no such pair: the common part cancels out."""
        return np.log(self.rest[1][before].astype(np.float64)) - np.log(self.rest[0][before].astype(np.float64))

    def added(self, before: np.ndarray, word: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """What pairs (rows of their words, counts by class) that training has add to that, in whole ``1 / UNIT``."""
        def backed(c: int, n: np.ndarray, lower: np.ndarray) -> np.ndarray:
            return np.maximum(n - PAIR_DISCOUNT, 0) / np.maximum(self.history[c][before], 1) + self.rest[c][before] * lower

        both = backed(2, pairs.sum(axis=0), self.common[word].astype(np.float64))
        ratio = np.log(backed(1, pairs[1], both)) - np.log(backed(0, pairs[0], both))
        return np.rint((ratio - self.alone(before)) * UNIT).astype(np.int64)


def _model(counts: DataFrame, shared, scratch: Scratch) -> DataFrame:
    """Written by bucket: the keys of the pairs that training has, in order, and what each adds to the second order."""

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            for bucket, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("bucket", "a", "b", "c"))):
                before, word = _unpacked(a), np.frombuffer(b, np.uint64)
                key = pair_key(before, word)
                value = models.added(models.at(before), models.at(word), _loose(c, np.int32).reshape(2, -1).astype(np.int64))
                by = np.argsort(key)
                yield _row(bucket=bucket, kind=0, a=_packed(key[by]), b=_squeezed(value[by].astype(np.int32)))

    return _written(scratch, counts.where("part < 0").select("bucket", "a", "b", "c").mapInArrow(final, _ROW), "model")


def _features(texts: DataFrame, model: DataFrame, buckets: int, shared, scratch: Scratch) -> DataFrame:
    """Written ``doc_id, n, f`` of every document: mean log-ratios, and the root of the share of words past each level."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, started = shared.value, 0
        for rows, w, before, ends in _blocks(batches, "doc_id"):
            block = TaskContext.get().partitionId() << 32 | started
            started += 1
            n = np.diff(ends)
            row = np.repeat(np.arange(len(n)), n)
            own = models.at(w)
            unknown = len(models.first) - 1
            last = np.concatenate([[0], own[:-1]])[:len(w)]
            last[ends[:-1][n > 0]] = models.at(np.zeros(1, np.uint64))[0]
            one = models.first[own]
            f = [np.bincount(row, weights=x, minlength=len(n)) for x in (one, models.alone(last))]
            f += [np.bincount(row[one > x], minlength=len(n)).astype(np.float64) for x in LEVELS]
            ids = rows.column("doc_id").to_pylist()
            yield _row(bucket=block % buckets, kind=2, block=block, ids=ids, a=np.stack([n.astype(np.float64), *f]).tobytes())
            # a pair with a word that training has not is no pair of its
            maybe = np.flatnonzero((own < unknown) & (last < unknown))
            key, place = np.unique(pair_key(before[maybe], w[maybe]), return_inverse=True)
            bucket = share_of(key, buckets)
            starts = _cuts(bucket)
            of = bucket[place]
            by = np.argsort(of, kind="stable")  # documents stay in order within a bucket
            place, doc, of = place[by], row[maybe][by], of[by]
            cuts = _cuts(of)
            for x, y, i, j in zip(starts, np.append(starts[1:], len(key)), cuts, np.append(cuts[1:], len(of))):
                yield _row(bucket=int(bucket[x]), kind=1, block=block, a=_packed(key[x:y]),
                           b=_squeezed((place[i:j] - x).astype(np.uint16 if y - x <= 1 << 16 else np.uint32)),
                           c=_squeezed(np.diff(doc[i:j], prepend=0).astype(np.uint16)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, key, value = -1, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in ("bucket", "kind", "block", "ids", "a", "b", "c")}
                kind, a, b, c = r["kind"].as_py(), r["a"].as_py(), r["b"].as_py(), r["c"].as_py()
                if r["bucket"].as_py() != bucket:
                    bucket, key, value = r["bucket"].as_py(), np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if kind == 0:
                    key, value = _unpacked(a), _loose(b, np.int32).astype(np.int64)
                elif kind == 1:
                    if not len(key):
                        continue
                    asked = _unpacked(a)
                    at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
                    found = np.where(key[at] == asked, value[at], 0)
                    found = found[_loose(b, np.uint16 if len(asked) <= 1 << 16 else np.uint32)]
                    doc = np.cumsum(_loose(c, np.uint16), dtype=np.int64)
                    doc, total = _summed(doc, found)
                    own = np.flatnonzero(total)
                    yield _row(bucket=bucket, kind=1, block=r["block"].as_py(), a=doc[own].astype(np.uint16).tobytes(), b=total[own].tobytes())
                else:
                    yield _row(bucket=bucket, kind=2, block=r["block"].as_py(), ids=r["ids"].as_py(), a=a)

    def finish(rows: pa.Table) -> pa.Table:
        kinds = rows.column("kind").to_pylist()
        own = kinds.index(2)
        ids = rows.column("ids")[own].as_py()
        f = np.frombuffer(rows.column("a")[own].as_py(), np.float64).reshape(-1, len(ids)).copy()
        more = np.zeros(len(ids), np.int64)
        for kind, a, b in zip(kinds, rows.column("a").to_pylist(), rows.column("b").to_pylist()):
            if kind == 1:
                more[np.frombuffer(a, np.uint16)] += np.frombuffer(b, np.int64)
        size = np.maximum(f[0], 1)
        f[2] += more / UNIT
        x = np.concatenate([f[1:3] / size, np.sqrt(f[3:] / size)])
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(f[0].astype(np.int64)),
                         "f": pa.array(list(x.T), pa.list_(pa.float64()))})

    parts = []
    for i in range(ROUNDS):
        own = texts.where(f"pmod(xxhash64(doc_id, text), {ROUNDS}) = {i}")
        asked = own.mapInArrow(ask, _ROW).unionByName(model).repartition("bucket").sortWithinPartitions("bucket", "kind")
        answered = asked.mapInArrow(answer, _ROW).groupBy("block").applyInArrow(finish, "doc_id long, n long, f array<double>")
        parts.append(_written(scratch, answered, f"features{i}"))
    return reduce(DataFrame.unionByName, parts)


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values], schema=pa.schema(
        [("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())),
         ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())]))


def logistic(x: np.ndarray, y: np.ndarray, strength: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([strength * len(x)] * (x.shape[1] - 1) + [1e-9])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fit_rows(labelled: int) -> Column:
    """Which labelled ids are kept from the models for the logistic fit: a fifth, or about ``FIT_ROWS`` of many."""
    return F.expr(f"pmod(xxhash64(doc_id, 'fit'), {1 << 30})") < int((1 << 30) * min(0.2, FIT_ROWS / max(labelled, 1)))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "toxicity")
    texts = id_text(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(
        ~held_out(F.col("doc_id")))
    fit = _fit_rows(known.count())
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-chars // (WORD_CHARS << PAIR_BITS)))
    counts = _counts(_training(texts, known.where(~fit)), buckets, scratch)
    shared = spark.sparkContext.broadcast(Models(_word_table(counts)))
    model = _model(counts, shared, scratch)
    scratch.drop("counts")
    measured = _features(texts, model, buckets, shared, scratch)
    scratch.drop("model")
    rows = measured.join(known.where(fit), "doc_id")
    got = rows.orderBy(F.xxhash64("doc_id")).select("toxic", "f").toArrow()
    y = got.column("toxic").to_numpy().astype(np.float64)
    x = np.array(got.column("f").to_pylist()).reshape(len(y), 2 + len(LEVELS))
    prior = float((y.sum() + 0.5) / (len(y) + 1))
    if 0 < y.sum() < len(y):
        mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        weights = logistic((x - mean) / spread, y)
    else:
        mean, spread, weights = np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1] + 1)
        weights[-1] = np.log(prior / (1 - prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = np.array(batch.column("f").to_pylist()).reshape(batch.num_rows, 2 + len(LEVELS))
            z = (((f - mean) / spread) * weights[:-1]).sum(axis=1) + weights[-1]
            score = np.where(batch.column("n").to_numpy() > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), prior)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = measured.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))

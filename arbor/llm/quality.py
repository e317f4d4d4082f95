"""Quality classifier with hierarchical empirical Bayes (operator 1).

A document's own evidence is a logistic regression over character classes,
word lengths and repetition, fitted on labelled rows (at most ``FIT_ROWS``,
taken by hash). Evidence is then pooled: every path of a host (here a language
of a source) has a posterior share of good documents that shrinks to its host's,
and the host's shrinks to the share of all documents. How strongly is estimated
from the spread between hosts, and between the paths of a host (method of
moments), so a sparse site stays near its parent and a large one speaks for
itself. A document's score is its own evidence with its site's posterior, less
the document itself, in place of the global prior.

Sites are counted by grouped aggregation: rows are partial sums before any
shuffle. The site table is written, so that Spark knows its size and broadcasts
it only where it is small; the texts are not shuffled for it then.

Defined cases: a null or empty text (or one of white space) scores 0 and is not
kept; a null host or path is a site of its own; labels that are null are no
labels, and a document labelled twice is good if all labels say so; without both
classes among the labels every document's own evidence is their share; repeated
rows are judged each; rows without an id are judged and never train;
:func:`keep_good` keeps all columns, :func:`classify` ignores other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Scratch, map_text, ship, slices
from .hashing import ngrams, string_buffer, words
from .toxicity import logistic

#: Bound of the labelled rows that the regression is fitted on.
FIT_ROWS = 50_000
#: A site moves a document's log-odds by so much at most: a clean document of a poor site can still be kept.
MOST_SHIFT = 1.5
#: Scores below it are rejected.
THRESHOLD = 0.5

# Character classes of bytes: lower, upper, digit, space, line end, stop, mark, symbol, bar, bracket or quote, other, high.
_CLASSES = 12
_CLASS = np.full(256, 10, np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:",
                             b"!?", b"#$%&*+=<>@^_~\\/", b"|", b"()[]{}\"'`-")):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 11
N_FEATURES = _CLASSES + 7


def features(col: pa.Array) -> np.ndarray:
    """Per text: shares of character classes, word length, repeated words and phrases, line length, length."""
    raw, offsets = string_buffer(col)
    size = np.diff(offsets)
    n = len(size)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * _CLASSES + _CLASS[raw], minlength=n * _CLASSES).reshape(n, _CLASSES)
    value, ends, start, stop = words(col)
    k = np.diff(ends)
    word_row = np.repeat(np.arange(n), k)
    per = np.maximum(k, 1)
    length = np.bincount(word_row, weights=stop - start, minlength=n) / per
    long_ = np.bincount(word_row[stop - start > 20], minlength=n) / per
    again = np.zeros(len(value), bool)
    if len(value):
        again[1:] = (value[1:] == value[:-1]) & (word_row[1:] == word_row[:-1])
    repeated = np.bincount(word_row[again], minlength=n) / per
    grams = ngrams(value, 3)
    phrase = np.zeros(n)
    capital = np.zeros(n)
    upper = (raw[start] >= 65) & (raw[start] <= 90) if len(start) else np.zeros(0, bool)
    capital = np.bincount(word_row[upper], minlength=n) / per
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        if b - a > 3:
            own = np.sort(grams[a:b - 2])
            phrase[i] = (own[1:] == own[:-1]).sum() / len(own)
    shares = counts / np.maximum(size, 1)[:, None]
    lines = np.log1p(size / (counts[:, 4] + 1))
    return np.column_stack([np.sqrt(shares), np.log1p(length), long_, np.sqrt(repeated), np.sqrt(phrase), capital, lines, np.log1p(k)])


def _rows(docs: DataFrame, host: str, path: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                       F.col(path).cast("string").alias("path"), F.col("text").cast("string").alias("text"))


def _fit(measured: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights over raw features (intercept last), and the least and most of each feature among the labelled rows.

    Features are cut to that range, so a document longer than any labelled one is judged like the longest of them.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    got = measured.where("words > 0").join(known, "doc_id").orderBy(F.xxhash64("doc_id")).limit(FIT_ROWS).select(
        "quality", "f").toArrow()
    y = got.column("quality").to_numpy().astype(np.float64)
    x = np.array(got.column("f").to_pylist(), np.float64).reshape(len(y), N_FEATURES)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return np.append(np.zeros(N_FEATURES), np.log(share / (1 - share))), np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    w = logistic((x - mean) / spread, y)
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum()), x.min(axis=0), x.max(axis=0)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _prior(groups: DataFrame, parent: Column, level: str) -> float:
    """Prior weight (in documents) of a level: from the spread of its groups' shares around their parent's share."""
    q = F.sum(F.col("n") * (F.col("s") / F.col("n") - parent) ** 2 / (parent * (1 - parent)))
    r = groups.agg(q.alias("q"), F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2")).first()
    if not r["k"] or r["n"] is None or r["n"] - r["n2"] / r["n"] <= 0:
        return 1e6  # one group: it has nothing to differ from
    spread = max((r["q"] - (r["k"] - 1)) / (r["n"] - r["n2"] / r["n"]), 1e-6)
    return float(min(max(1 / spread - 1, 1.0), 1e6))


class Sites:
    """The global share, the prior weights and the written site table."""

    def __init__(self, evidence: DataFrame, scratch: Scratch):
        counts = scratch.write(evidence.where("words > 0").groupBy("host", "path").agg(
            F.count("*").alias("n"), F.sum("p").alias("s")), "counts")
        total = counts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
        self.share = min(max((total["s"] + 0.5) / (total["n"] + 1), 1e-4), 1 - 1e-4) if total["n"] else 0.5
        hosts = counts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        self.host_weight = _prior(hosts, F.lit(self.share), "host")
        hosts = hosts.select(F.col("host").alias("_host"),
                             ((F.col("s") + self.host_weight * self.share) / (F.col("n") + self.host_weight)).alias("host_share"))
        joined = scratch.write(counts.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "hosts")
        inside = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), F.col("host_share")))
        self.path_weight = _prior(joined, inside, "path")
        self.table = scratch.write(joined.select(
            F.col("host").alias("_host"), F.col("path").alias("_path"), "host_share",
            (F.col("s") + self.path_weight * F.col("host_share")).alias("_s"), (F.col("n") + self.path_weight).alias("_n")), "sites")

    def judged(self, evidence: DataFrame) -> DataFrame:
        """``evidence`` with ``host_share, path_share, score, keep``; ``host`` and ``path`` name the site, ``z`` is the log-odds."""
        on = F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
        p = 1 / (1 + F.exp(-F.col("z")))
        # the document itself is left out of its site's counts
        path = (F.col("_s") - p) / (F.col("_n") - 1)
        path = F.least(F.lit(1 - 1e-4), F.greatest(F.lit(1e-4), path))
        path = F.coalesce(path, F.lit(self.share))
        shift = F.least(F.lit(MOST_SHIFT), F.greatest(F.lit(-MOST_SHIFT), _logit(path) - float(np.log(self.share / (1 - self.share)))))
        score = F.when(F.col("words") > 0, 1 / (1 + F.exp(-(F.col("z") + shift)))).otherwise(0.0)
        return (evidence.join(self.table, on, "left").withColumn("path_share", path).withColumn("score", score)
                .withColumn("keep", F.col("score") >= THRESHOLD).drop("_host", "_path", "_s", "_n"))


def _evidence(measured: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """``z`` (log-odds) and ``p`` of each row's features, as one native expression."""
    weights, low, high = model
    z = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        z = z + F.least(F.greatest(F.col("f")[i], F.lit(float(low[i]))), F.lit(float(high[i]))) * float(w)
    z = F.least(F.lit(30.0), F.greatest(F.lit(-30.0), z))
    return measured.withColumn("z", z).withColumn("p", 1 / (1 + F.exp(-F.col("z")))).drop("f")


def _measured(rows: DataFrame, scratch: Scratch) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        f = features(batch.column("text"))
        ends = np.arange(len(f) + 1, dtype=np.int32) * N_FEATURES
        return {"doc_id": batch.column("doc_id"), "host": batch.column("host"), "path": batch.column("path"),
                "words": np.rint(np.expm1(f[:, -1])).astype(np.int64),
                "f": pa.ListArray.from_arrays(pa.array(ends), pa.array(f.ravel()))}

    return scratch.write(
        map_text(rows, "text", run, "doc_id long, host string, path string, words long, f array<double>"), "features")


def _model(docs: DataFrame, labels: DataFrame, host: str, path: str) -> tuple[DataFrame, tuple, Sites]:
    scratch = Scratch(docs.sparkSession, "quality")
    measured = _measured(_rows(docs, host, path), scratch)
    model = _fit(measured, labels)
    evidence = _evidence(measured, model)
    return evidence, model, Sites(evidence, scratch)


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """``doc_id, host, path, p_doc, host_share, path_share, score, keep`` of every document."""
    evidence, _, sites = _model(docs, labels, host, path)
    return sites.judged(evidence).select(
        "doc_id", "host", "path", F.col("p").alias("p_doc"), F.coalesce("host_share", F.lit(sites.share)).alias("host_share"),
        "path_share", "score", "keep")


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """All columns of the documents that are kept. Each row is judged by its own text in a second pass."""
    ship(docs.sparkSession)
    _, (weights, low, high), sites = _model(docs, labels, host, path)
    cols = docs.columns
    named = [f"_in_{i}" for i in range(len(cols))]
    rows = docs.select(*[F.col(c).alias(x) for c, x in zip(cols, named)], F.col(host).cast("string").alias("host"),
                       F.col(path).cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    schema = StructType([*rows.schema.fields[:-1], StructField("z", DoubleType()), StructField("words", DoubleType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            f = features(part.column("text"))
            z = np.clip(np.clip(f, low, high) @ weights[:-1] + weights[-1], -30, 30)
            kept = [part.column(i) if part.column(i).type == t.type else part.column(i).cast(t.type) for i, t in enumerate(list(out)[:-2])]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(z), pa.array(np.rint(np.expm1(f[:, -1])))], schema=out)

    judged = sites.judged(rows.mapInArrow(run, schema))
    return judged.where("keep").select(*[F.col(x).alias(c) for c, x in zip(cols, named)])

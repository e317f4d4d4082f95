"""URL filters by a ratio of character language models (operator 3).

Rules come first: the longest rule whose host is the url's or a parent domain of
it, and whose path the url's path starts with, decides. Other urls are judged by
two variable-order Markov models over characters, of accepted and of rejected
urls. Each model interpolates orders 0 to 5 (Witten-Bell: a context gives way to
its shorter one by how many different characters followed it), so a long context
counts where it was seen and a short one elsewhere. The score is the difference
of the two log-likelihoods per character; the threshold is calibrated on the
scores of the labelled urls (highest balanced accuracy).

The models read the whole url: scheme, host, path, query and fragment (A-Z
lower-cased, digits in a row as one). Labels are weak: urls whose words hold a
rejected term are rejected examples, the others accepted ones. Hosts are dealt
into ``FOLDS`` folds by hash, and every url is scored by models of the other
folds' urls, so neither its score nor the threshold knows its own label or host.

Runs of six characters are counted in Spark, by class and fold, over the
distinct urls; shorter runs are sums of longer ones. The table grows with the
urls and stays in Spark: urls are joined with it run by run. The most frequent
runs (at most ``HOT``) are broadcast, so no run is a hot key. Sums are in whole
``1 / UNIT``, so they do not depend on the order of addition.

Defined cases: a null or empty url scores 0 and is allowed; one without ``://``
has empty host and path and is scored like others; very long urls are read
whole; rules need a path that starts with theirs, so ``net/`` does not fit a url
without a path; of fitting rules of one length the later in the list wins;
without rejected (or accepted) examples all are allowed; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# Words of urls that make them a rejected example.
REJECTED_TERMS = ("ad", "ads", "adult", "bet", "bets", "betting", "casino", "cheap", "click", "escort", "free", "gambling",
                  "loan", "loans", "lottery", "pills", "poker", "porn", "seo", "sex", "spam", "track", "tracker", "tracking",
                  "viagra", "win", "xxx")
#: Characters of a run (the last one and its context), and what stands before a url's first character.
RUN, START = 6, "\x01"
#: Folds of hosts, runs that are broadcast at most, steps to one of a log-ratio.
FOLDS, HOT, UNIT = 4, 1 << 16, 1 << 20
BINS = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 1000
#: Models: rejected (0) and accepted (1), each without one fold.
_MODELS = [(c, f) for c in (0, 1) for f in range(FOLDS)]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (as written) and its verdict, or nulls. ``rules``: (host, path, verdict)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules fit into one expression")
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _runs(strings: DataFrame) -> DataFrame:
    """``string_id, label, fold, run``: every character of every string with its context."""
    chars = F.split(F.concat(F.lit(START * (RUN - 1)), F.col("text")), "")
    padded = strings.select("string_id", "label", "fold", F.length("text").alias("n"), chars.alias("p"))
    each = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat(*[F.element_at("p", (i + k).cast("int")) for k in range(RUN)]))
    return padded.select("string_id", "label", "fold", F.explode(each).alias("run"))


def _ratios(strings: DataFrame, scratch: Scratch) -> DataFrame:
    """Written ``run, n, ratio``: how often a run is there, and by fold its log-ratio (accepted to rejected) in whole ``1 / UNIT``."""
    counts = scratch.write(_runs(strings).groupBy("run").agg(
        F.count("*").alias("n"),
        *[F.count(F.when((F.col("label") == c) & (F.col("fold") != f), 1)).alias(f"n{c}{f}") for c, f in _MODELS]), "counts")
    symbols = counts.select(F.substring("run", RUN, 1).alias("s")).distinct().count()
    lower = None
    for k in range(1, RUN + 1):
        own = counts.groupBy(F.substring("run", RUN + 1 - k, k).alias("run")).agg(
            F.sum("n").alias("n"), *[F.sum(f"n{c}{f}").alias(f"n{c}{f}") for c, f in _MODELS])
        context = own.groupBy(F.substring("run", 1, k - 1).alias("context")).agg(
            *[F.sum(f"n{c}{f}").alias(f"t{c}{f}") for c, f in _MODELS],
            *[F.count(F.when(F.col(f"n{c}{f}") > 0, 1)).alias(f"k{c}{f}") for c, f in _MODELS])
        own = own.withColumn("context", F.substring("run", 1, k - 1)).join(context, "context")
        if lower is None:
            own = own.select("*", *[F.lit(1 / max(symbols, 1)).alias(f"b{c}{f}") for c, f in _MODELS])
        else:
            own = own.withColumn("shorter", F.substring("run", 2, k - 1)).join(lower, "shorter")
        p = {m: F.when(F.col("t%d%d" % m) > 0, (F.col("n%d%d" % m) + F.col("k%d%d" % m) * F.col("b%d%d" % m))
                       / (F.col("t%d%d" % m) + F.col("k%d%d" % m))).otherwise(F.col("b%d%d" % m)) for m in _MODELS}
        if k < RUN:
            lower = scratch.write(own.select(F.col("run").alias("shorter"), *[p[m].alias("b%d%d" % m) for m in _MODELS]), f"order{k}")
    ratio = F.array(*[F.rint((F.log(p[1, f]) - F.log(p[0, f])) * UNIT).cast("long") for f in range(FOLDS)])
    return scratch.write(own.select("run", "n", ratio.alias("ratio")), "ratios")


def _scored(strings: DataFrame, ratios: DataFrame, scratch: Scratch) -> DataFrame:
    """Written ``text, label, score``: mean log-ratio per character by the models without the string's fold."""
    hot = scratch.write(ratios.orderBy(F.desc("n"), "run").limit(HOT), "hot")
    runs = _runs(strings)
    near = runs.join(F.broadcast(hot), "run")
    far = runs.join(F.broadcast(hot.select("run")), "run", "left_anti").join(ratios, "run")
    value = F.element_at("ratio", F.col("fold") + 1).alias("value")
    total = near.select("string_id", value).unionByName(far.select("string_id", value)).groupBy("string_id").agg(
        F.sum("value").alias("total"))
    return scratch.write(strings.join(total, "string_id").select(
        "text", "label", (F.col("total") / UNIT / F.length("text")).alias("score")), "scored")


def threshold(bins: list[tuple[int, int, int]]) -> float:
    """The score below which urls are rejected: highest balanced accuracy over ``(bin, label, n)``, middle of the best range."""
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for b, label, n in bins:
        (good if label else bad)[b] += n
    if not good.sum() or not bad.sum():
        return -np.inf
    right = np.concatenate([[0], np.cumsum(bad)]) / bad.sum() + 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 / BINS * 16 - 8)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], rejected_terms: tuple[str, ...] = REJECTED_TERMS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page."""
    host, path = host_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"),
        F.regexp_replace(F.translate(F.coalesce("url", F.lit("")), UPPER, LOWER), "[0-9]+", "0").alias("text"))
    label = F.when(F.arrays_overlap(F.split("text", "[^a-z]+"), F.array(*map(F.lit, rejected_terms))), 0).otherwise(1)
    scratch = Scratch(pages.sparkSession, "urls")
    strings = rows.where("text <> ''").groupBy("text").agg(F.min("host").alias("host")).select(
        F.monotonically_increasing_id().alias("string_id"), "text", label.alias("label"),
        F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int").alias("fold"))
    strings = scratch.write(strings, "strings")
    scored = _scored(strings, _ratios(strings, scratch), scratch)
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + 8) / 16 * BINS))).cast("int")
    cut = threshold([(r["bin"], r["label"], r["count"]) for r in scored.groupBy(place.alias("bin"), "label").count().collect()])
    judged = rows.join(scored.select("text", "score"), "text", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("text") == "") | (F.col("score") >= cut), "allow").otherwise("block")
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score")

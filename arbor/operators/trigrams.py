"""Name lookup by pattern for whole tables of patterns, over trigram postings.

``LIKE '%,<name>,%'`` on the packed names, one pattern at a time, is a scan each. Here every
packed name is cut into its runs of three characters once, and stored as ``(trigram, id)`` with
the ids per trigram counted. A pattern's literal parts have trigrams that every match must
have; the rarest of them names the candidates, and only these are compared with the pattern.
A pattern with a trigram that no name has matches nothing and reads no posting. Patterns
without any (wildcards around one or two characters) can match anything, so they are
answered from the names directly, ``TOGETHER`` at a time in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NAME_SEP
from ..plans.materialize import RoundWriter

#: Patterns without trigrams that one scan answers.
TOGETHER = 64
#: The wildcards of LIKE and its escape character, which end a literal part.
WILD_REGEX = r"[%_\\]"


@dataclass
class Postings:
    """``rows``: ``(trigram, id)``, sorted by trigram; ``counts``: ``(trigram, n)``; ``names``: ``(id, name)``."""

    rows: DataFrame
    counts: DataFrame
    names: DataFrame


def _trigrams(text: Column) -> Column:
    """The different runs of three characters; none for shorter texts."""
    places = F.when(F.length(text) >= 3, F.sequence(F.lit(1), F.length(text) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: text.substr(i, F.lit(3))))


def build_postings(vertices: DataFrame) -> Postings:
    """Store the postings of the packed names of ``(id, name, ..)``."""
    writer = RoundWriter(vertices, "trigrams")
    names = vertices.where("name IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), "name")
    rows = names.select(F.explode(_trigrams(F.col("name"))).alias("trigram"), "id")
    # a trigram of very many names is cut into many files by id
    rows = writer.write(rows.repartitionByRange("trigram", "id").sortWithinPartitions("trigram", "id"), "rows")
    counts = writer.write(rows.groupBy("trigram").agg(F.count(F.lit(1)).alias("n")), "counts")
    return Postings(rows, counts, names)


def _answer(patterns: DataFrame, best: DataFrame) -> DataFrame:
    out = patterns.join(best, "name", "left")
    vid = F.when(F.col("name") == F.lit(""), F.lit(-1)).otherwise(F.coalesce("vid", F.lit(-1)))
    return out.select("name", vid.cast("bigint").alias("vid"))


def _scanned(names: DataFrame, patterns: Iterator[str]) -> Iterator[DataFrame]:
    """``(name, vid)`` of patterns that have no trigram: a scan for each ``TOGETHER`` of them."""
    for some in batched(patterns, TOGETHER):
        best = [F.min(F.when(F.col("name").like(f"%{NAME_SEP}{p}{NAME_SEP}%"), F.col("id"))).alias(f"m{i}") for i, p in enumerate(some)]
        found = names.agg(*best)
        yield found.select(F.stack(F.lit(len(some)), *[c for i, p in enumerate(some) for c in (F.lit(p), F.col(f"m{i}"))]).alias("name", "vid"))


def find_ids_like(postings: Postings, patterns: DataFrame, name_col: str = "name") -> DataFrame:
    """``(name, vid)`` for each distinct pattern: the smallest id whose packed name is ``LIKE '%,<name>,%'``; -1 if none or empty."""
    writer = RoundWriter(patterns, "patterns")
    q = writer.write(patterns.select(F.col(name_col).cast("string").alias("name")).where("name IS NOT NULL").distinct(), "asked")
    whole = F.concat(F.lit(NAME_SEP), F.col("name"), F.lit(NAME_SEP))
    parts = F.transform(F.split(whole, WILD_REGEX), _trigrams)
    cut = writer.write(q.where("name <> ''").withColumn("t", F.array_distinct(F.flatten(parts))), "cut")
    need = cut.select("name", F.explode("t").alias("trigram")).join(postings.counts, "trigram", "left")
    rarest = need.groupBy("name").agg(F.min_by("trigram", F.coalesce("n", F.lit(0).cast("bigint"))).alias("trigram"),
                                      F.min(F.coalesce("n", F.lit(0).cast("bigint"))).alias("least"))
    rarest = writer.write(rarest.where("least > 0").select("name", "trigram"), "rarest")
    # candidates are the names that hold the rarest trigram; a trigram that many have is split by Spark's skew join
    candidates = rarest.join(postings.rows, "trigram").select("name", "id")
    named = candidates.join(postings.names.select("id", F.col("name").alias("_packed")), "id")
    hit = F.like(F.col("_packed"), F.concat(F.lit("%"), whole, F.lit("%")))
    best = named.where(hit).groupBy("name").agg(F.min("id").alias("vid"))
    bare = (r["name"] for r in cut.where(F.size("t") == 0).select("name").toLocalIterator())
    for more in _scanned(postings.names, bare):
        best = best.unionByName(more)
    return _answer(q, best)

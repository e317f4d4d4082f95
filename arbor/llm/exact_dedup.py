"""Exact deduplication by skew-safe combining (operator 11), in DataFrame functions only.

Texts are equal when they are identical after lower-casing A-Z; of equal texts the
row with the largest id stays. Groups are combined in three steps, and each groups
by the whole normalised text beside its digest, so full contents are compared:

1. locally: the partial aggregate of a task folds the task's equal texts into one;
2. salted: the tasks' groups of a digest are merged by ``(digest, text, salt)``. The
   salt is 0, but for hot digests it is taken from the task's number, so a text that
   every task holds is merged in ``SALTS`` places at once;
3. globally: the salt winners of the hot digests, at most ``SALTS`` a text, are merged.

Hot digests hold at least one in ``HOT_SHARE`` of all rows, so there are at most
``HOT_SHARE`` of them: that table is broadcast, here and when groups are handed back to
the rows. All other rows meet their group in a join by digest, where no key has more
than one in ``HOT_SHARE`` of the rows. Texts are shuffled once; after that only digests,
ids and counts move. Should two different texts ever share a digest, the rows of that
digest are joined with their groups by the text itself.

Defined cases: a null text counts as empty, and empty texts are equal to each other; a
null id counts as smaller than any other, so it stays only where no row of its group
has an id (``keep_id`` is null then); of rows with the same id and equal texts, all count
and exactly one stays; very long texts are compared whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh

#: Digests with at least one in so many rows are hot: a bound of the broadcast table's rows.
HOT_SHARE = 1024
#: Places where the groups of a hot digest are merged.
SALTS = 64

# Fixed value: the letters that are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased; null is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # for texts of ASCII alone, lower() does the same and is faster
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("content"))
    return rows.select("doc_id", "content", digest(F.col("content")).alias("digest"))


def _merged(rows: DataFrame, hot: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``digest, content, keep_id, group_size`` of every different text; ``content`` is null where it was not salted."""
    flagged = rows.join(F.broadcast(hot.select("digest", F.lit(True).alias("hot"))), "digest", "left")
    salted = flagged.withColumn("salt", F.when(F.col("hot"), F.spark_partition_id() % SALTS).otherwise(F.lit(-1)))
    winners = salted.groupBy("digest", "content", "salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # the text goes on only where salt winners must still be compared
    stored = scratch.write(winners.select("digest", F.when(F.col("salt") >= 0, F.col("content")).alias("content"),
                                          "keep_id", "group_size"), tag)
    whole = stored.where("content IS NOT NULL").groupBy("digest", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return stored.where("content IS NULL").unionByName(whole)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` of every row; ``digest`` is binary (of the normalised text)."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    texts = _rows(docs, id_col, text_col, digest)
    # the narrow rows, under numbers of their own: rows with the same id and text differ by them
    rows = scratch.write(texts.select("doc_id", "digest", F.monotonically_increasing_id().alias("row")), "rows")
    by_digest = scratch.write(rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("last")), "digests")
    total = rows.count()
    hot = by_digest.where((F.col("n") > 1) & (F.col("n") * HOT_SHARE >= total)).select("digest")
    merged = scratch.write(_merged(texts, hot, scratch, "merged").select("digest", "keep_id", "group_size"), "groups")
    clashing = scratch.write(merged.groupBy("digest").count().where("count > 1").select("digest"), "clashing")
    known = merged.join(by_digest.select("digest", F.col("last.row").alias("last"), (F.col("n") * HOT_SHARE >= total).alias("hot")), "digest")
    if not clashing.isEmpty():
        known = known.join(clashing, "digest", "left_anti")
        rows, apart = rows.join(clashing, "digest", "left_anti"), _apart(texts, clashing, scratch)
    else:
        apart = None
    known = scratch.write(known, "known")
    # at most HOT_SHARE digests are hot
    own = known.where("hot AND group_size > 1").drop("hot")
    near = rows.join(F.broadcast(own), "digest")
    far = rows.join(F.broadcast(own.select("digest")), "digest", "left_anti").join(
        known.where("NOT hot OR group_size = 1").drop("hot"), "digest")
    out = near.unionByName(far).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("last")).alias("kept"), "digest")
    return out if apart is None else out.unionByName(apart)


def _apart(texts: DataFrame, clashing: DataFrame, scratch: Scratch) -> DataFrame:
    """The same result for rows whose digest stands for several texts: they meet their group by the text."""
    rows = scratch.write(texts.join(clashing, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id()), "apart")
    own = rows.groupBy("digest", "content", (F.col("row") % SALTS).alias("salt")).agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("n"))
    own = own.groupBy("digest", "content").agg(F.max("last").alias("last"), F.sum("n").alias("group_size"))
    return rows.join(own, ["digest", "content"]).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"), "digest")


def report(found: DataFrame) -> DataFrame:
    """The query's columns: the digest in lower-case hexadecimal."""
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that agree in id and normalised text are one document: any one of them stays.
    """
    key, mark = fresh(docs, "_id"), fresh(docs, "_digest")
    stay = groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(key), F.col("digest").alias(f"{mark}_kept"))
    marked = docs.withColumn(mark, sha256(normalised(F.col(text_col))))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(f"{mark}_kept"))
    return marked.join(stay, same, "left_semi").dropDuplicates([id_col, mark]).drop(mark)

"""The corpus pipeline: documents in, token ids out.

Each stage calls one operator of :mod:`arbor.llm` on all rows that the stage
before it kept. A stage's result is written to the shared folder and read back
before the next one, so a lost executor costs work of one stage at most.

1. ``quality``: documents that the quality classifier rejects go.
2. ``near_duplicates``: of each group of near duplicates (five-word shingles,
   Jaccard 0.8 or more, linked ones together) the one with the smallest id stays.
   Every row is judged by its own text: of rows that share an id and a text one
   stays, rows that share an id and differ are apart, and a row without an id
   stays unless a row like it has one. Rows without words have no copies.
3. ``decontamination``: documents that overlap a benchmark item go.
4. ``secrets``: secrets in the text are replaced by a mark (``n_chars`` follows).
5. ``bpe``: the text as token ids.

All stages but the last return the columns of the documents, extra ones too.

Defined cases: a null text stays null up to the last stage, where it is encoded as
empty, like an empty one; very long texts go through whole; a row without an id is
judged like any other; an empty table gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbor.llm import bpe, decontam, jaccard, quality, secret_scan
from arbor.llm.common import Scratch, by_ids, fresh, table
from arbor.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    row = fresh(docs, "_row")
    # rows under numbers of their own, written once so that these stay: a row is judged by its own text
    rows = scratch.write(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = jaccard.near_duplicates(rows.select(F.col(row).alias("doc_id"), F.col("text").alias("text")), k=5, percent=80)
    ids = rows.select(F.col(row).alias("r"), F.col("doc_id").cast("long").alias("id"))
    found = scratch.write(groups.select(F.col("doc_id").alias("r"), "component_id").join(ids, "r"), "groups")
    # the smallest id of a group stays, and a row without one only where none has
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("r"))).alias("first"),
                                              F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # written, so that the join with a very large group's rows is one that Spark splits
    first = scratch.write(first.select("component_id", F.col("first.r").alias("stays")), "first")
    removed = found.join(first, "component_id").where(F.col("r") != F.col("stays")).select("r")
    # a narrow table, written: Spark knows its size and broadcasts it only where it is small
    return by_ids(rows, scratch.write(removed, "removed"), "left_anti", row).drop(row)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, vocabulary()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("bpe", bpe_stage),
]

#: SQL cannot express the classifier, the tokens or the tolerant overlaps; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline-run")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs

"""Chat formatting by perspective rotation (operator 7), with DataFrame functions only.

Every participant of a dialogue is the assistant once: for each of them all
turns are rendered, the participant's own as ``assistant``, the others' as
``user`` with their name, system turns as ``system``; the loss mask covers the
participant's own words and the end mark after them.

The result has a row per conversation, perspective and turn, in the order of
``turn``, so a conversation of any length is spread over tasks: nothing is
gathered but a conversation's distinct speakers, and the join that gives each
turn its perspectives is one that Spark splits where a conversation is very
long. :func:`dialogues` joins segments to whole texts where dialogues are known
to be of bounded length.

Defined cases: a null text is empty; a null speaker is called ``unknown``; rows
without a conversation id are one conversation with a null id; a null turn is
kept and sorts first; repeated rows are rendered each; a conversation of system
turns only has no participant and no rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks around a turn, the speaker that is no participant, and the name of one without a name.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"


def rotate(conversations: DataFrame) -> DataFrame:
    """``conv_id, perspective, turn, speaker, as_role, segment, mask_start, mask_stop``.

    ``mask_start`` and ``mask_stop`` are code points within the segment, end
    exclusive; both are 0 where nothing is learned.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    speakers = turns.where(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    head = F.concat(F.lit(OPEN), F.when(F.col("as_role") == "user", F.concat(F.lit("user name="), F.col("speaker"))).otherwise(
        F.col("as_role")), F.lit("\n"))
    return (
        turns.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .withColumn("as_role", role)
        .withColumn("_head", head)
        .select(
            "conv_id", "perspective", "turn", "speaker", "as_role",
            F.concat("_head", "text", F.lit(CLOSE + "\n")).alias("segment"),
            F.when(F.col("as_role") == "assistant", F.length("_head").cast("long")).otherwise(0).alias("mask_start"),
            F.when(F.col("as_role") == "assistant", (F.length("_head") + F.length("text") + len(CLOSE)).cast("long")).otherwise(0)
            .alias("mask_stop")))


def dialogues(rotated: DataFrame) -> DataFrame:
    """``conv_id, perspective, text, masks`` of dialogues of bounded length: segments joined by turn, masks as spans of the text.

    Turns with the same number are ordered by speaker and segment.
    """
    parts = rotated.groupBy("conv_id", "perspective").agg(
        F.sort_array(F.collect_list(F.struct("turn", "speaker", "segment", "mask_start", "mask_stop"))).alias("parts"))
    spans = F.expr("""
        aggregate(parts, struct(0L AS at, CAST(array() AS array<struct<start: bigint, stop: bigint>>) AS spans),
            (acc, p) -> struct(acc.at + length(p.segment) AS at,
                if(p.mask_stop > 0, concat(acc.spans, array(struct(acc.at + p.mask_start AS start, acc.at + p.mask_stop AS stop))),
                   acc.spans) AS spans),
            acc -> acc.spans)""")
    return parts.select("conv_id", "perspective", F.expr("array_join(transform(parts, p -> p.segment), '')").alias("text"),
                        spans.alias("masks"))

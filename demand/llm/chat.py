"""Chat formatting: multi-party perspective rotation, in DataFrame operations only.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and
all others as named users; ``mask`` has one digit per message (1: the assistant speaks, train on it) and
``spans`` the character ranges of the assistant's texts in ``rendered``.

A conversation is cut into chunks of ``turns_per_chunk`` messages (most have one chunk), so no row and no group
grows with the input. A message's place is found in two steps: counts of blocks of 1024 turns are
summed up per conversation, and messages are numbered inside their block.

Defined results: messages are ordered by turn, role, text (nulls first; equal rows are interchangeable and all
kept); a null role is the speaker ``unknown``; a null text is empty; a null conv_id is a conversation of its own.
An empty table gives no rows. Other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS_PER_CHUNK = 256
BLOCK = 1024


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, speaker, text, pos): pos counts from 0 within a conversation."""
    rows = conversations.select(
        F.col("conv_id"), F.col("turn"), F.coalesce("role", F.lit("unknown")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"), F.floor(F.col("turn") / BLOCK).alias("block"))
    order = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_first(), "speaker", "text")
    before = Window.partitionBy("c").orderBy(F.col("b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.groupBy(F.col("conv_id").alias("c"), F.col("block").alias("b")).agg(F.count("*").alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))))
    return (rows.withColumn("rn", F.row_number().over(order))
            .join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
            .select("conv_id", "speaker", "text", (F.col("start") + F.col("rn") - 1).alias("pos")))


def _header(speaker: Column, perspective: Column) -> Column:
    return F.when(speaker == perspective, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), speaker, F.lit("|>\n")))


def rotate(conversations: DataFrame, turns_per_chunk: int = TURNS_PER_CHUNK) -> DataFrame:
    """One row per conversation, participant and chunk: rendered, mask, spans, n_messages, n_target_chars."""
    messages = numbered(conversations)
    parts = (messages.groupBy("conv_id", F.floor(F.col("pos") / turns_per_chunk).cast("long").alias("chunk"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "speaker", "text"))).alias("m")))
    speakers = messages.select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    p = F.col("perspective")
    end = "<|end|>\n"
    pieces = F.transform("m", lambda x: F.concat(_header(x["speaker"], p), x["text"], F.lit(end)))
    no_spans = F.array().cast("array<struct<start:long,end:long>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(_header(x["speaker"], p))
        stop = start + F.length(x["text"])
        mine = F.array(F.struct(start.alias("start"), stop.alias("end")))
        return F.struct((stop + len(end)).alias("at"),
                        F.when(x["speaker"] == p, F.concat(acc["spans"], mine)).otherwise(acc["spans"]).alias("spans"))

    folded = F.aggregate("m", F.struct(F.lit(0).cast("long").alias("at"), no_spans.alias("spans")), step, lambda acc: acc["spans"])
    return (parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "perspective", "chunk", F.size("m").cast("long").alias("n_messages"),
                    F.array_join(pieces, "").alias("rendered"),
                    F.array_join(F.transform("m", lambda x: F.when(x["speaker"] == p, "1").otherwise("0")), "").alias("mask"),
                    folded.alias("spans"))
            .withColumn("n_target_chars", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])))


def spans_text(spans: Column) -> Column:
    """``start-end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")

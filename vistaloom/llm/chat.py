"""Chat formatting with rotated perspectives: the dialogue once for every participant, who is the assistant there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns in a rendered part, so that no conversation, however long, becomes one row.
PART = 64


def escaped(text: Column) -> Column:
    """A message cannot forge a marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotated(conversations: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, perspective, part, n_turns, text, mask): each dialogue from the side of each of its participants.

    Participants are the roles of a conversation except `system`; a null role is `unknown`. The perspective's messages are
    the assistant's, others are users with their names, system messages stay. mask lists the [start, end) places, in
    characters of text, of the assistant's words with their end markers: the loss is taken there. A dialogue is cut at each
    `part` turn numbers, and its parts in order make up the whole; a null turn comes first, in part -1. Ties of one turn are
    ordered by role and text, repeated rows stay, null texts are empty. A conversation with system messages only, and rows
    with a null conv_id, give nothing. Extra columns are ignored. An empty table gives no rows.
    """
    rows = conversations.where("conv_id is not null").select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / part), F.lit(-1)).cast("long").alias("part"),
        "turn",
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        escaped(F.col("text")).alias("said"),
    )
    speakers = rows.where("role <> 'system'").select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "said"))).alias("messages"))
    each = parts.join(speakers, F.col("conv_id") == F.col("of")).drop("of")
    own = F.col("perspective")

    def head(m: Column) -> Column:
        return (
            F.when(m["role"] == own, F.lit("<|im_start|>assistant\n"))
            .when(m["role"] == "system", F.lit("<|im_start|>system\n"))
            .otherwise(F.concat(F.lit("<|im_start|>user name="), escaped(m["role"]), F.lit("\n")))
        )

    end = "<|im_end|>"
    shown = each.withColumn("pieces", F.transform("messages", lambda m: F.struct(F.concat(head(m), m["said"], F.lit(end + "\n")).alias("piece"), F.length(head(m)).alias("head"), (m["role"] == own).alias("own"))))
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["piece"])).alias("at"),
            F.when(p["own"], F.concat(a["spans"], F.array(F.struct((a["at"] + p["head"]).alias("start"), (a["at"] + F.length(p["piece"]) - 1).alias("end"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return shown.select("conv_id", "perspective", "part", F.size("messages").cast("long").alias("n_turns"), F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"), spans.alias("mask"))

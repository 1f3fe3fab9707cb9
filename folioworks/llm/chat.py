"""Multi-party perspective rotation of dialogues, with DataFrame functions only.

Every participant of a conversation in turn becomes the assistant; the others are users with their names. What the
assistant says is marked for the loss by character spans, everything else is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Turns of one rendered piece lie in one range of so many turn numbers.
PIECE_TURNS = 256
NO_ID = -(2**63)


def _plain(text: Column) -> Column:
    """Text that cannot be taken for a marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(
    conversations: DataFrame, context: Sequence[str] = ("system",), piece_turns: int = PIECE_TURNS,
    conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``conv_id, perspective, piece, n_turns, n_own, text, mask`` for every participant and piece of a conversation.

    A piece holds the turns numbered from ``piece * piece_turns`` on, so that a conversation of any length is rendered
    in pieces of bounded size; the pieces in order are the dialogue. ``mask`` lists the spans (first character, end) of the
    assistant's words and their closing marker. Speakers in ``context`` keep their role in every perspective and are no
    participants; a null role is the user ``unknown`` and none either. A null text is empty, turns of equal number
    (repeated rows as well) all stay, ordered by role and text; null turns form a piece of their own, numbered
    null; rows without a conversation id form one conversation. Other columns are not read.
    """
    turns = conversations.select(
        F.coalesce(conversations[conv], F.lit(NO_ID)).alias("_c"), conversations[conv].isNull().alias("_none"),
        F.coalesce(F.floor(conversations[turn] / piece_turns), F.lit(NO_ID)).alias("_p"),
        conversations[turn].alias("turn"), conversations[role].alias("role"), _plain(conversations[text]).alias("text"),
    )
    speaker = F.col("role").isNotNull() & ~F.col("role").isin(*context)
    who = turns.where(speaker).groupBy("_c", "_none").agg(F.array_sort(F.collect_set("role")).alias("who"))
    places = turns.select("_c", "_none", "_p").distinct().join(who, ["_c", "_none"])
    # Pieces and their list of participants are partitioned alike: the texts cross the network once.
    pieces = turns.groupBy("_c", "_none", "_p").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    both = pieces.join(places, ["_c", "_none", "_p"]).withColumn("perspective", F.explode("who"))

    own = F.col("perspective")

    def head(t: Column) -> Column:
        name = F.coalesce(t["role"], F.lit("unknown"))
        label = F.when(t["role"] == own, F.lit("assistant")).when(t["role"].isin(*context), name)
        return F.concat(F.lit(OPEN), F.coalesce(label, F.concat(F.lit("user name="), _plain(name))), F.lit("\n"))

    parts = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("said"), F.coalesce(t["role"] == own, F.lit(False)).alias("own")
    ))
    shown = both.withColumn("_parts", parts)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(a: Column, p: Column) -> Column:
        low = a["at"] + F.length(p["head"])
        high = low + F.length(p["said"])
        span = F.struct(low.alias("start"), high.alias("end"))
        return F.struct((high + 1).alias("at"), F.when(p["own"], F.concat(a["mask"], F.array(span))).otherwise(a["mask"]).alias("mask"))

    return shown.select(
        F.when(~F.col("_none"), F.col("_c")).alias(conv), "perspective", F.nullif(F.col("_p"), F.lit(NO_ID)).alias("piece"),
        F.size("_parts").cast("bigint").alias("n_turns"), F.size(F.filter("_parts", lambda p: p["own"])).cast("bigint").alias("n_own"),
        F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["said"], F.lit("\n"))), "").alias("text"),
        F.aggregate("_parts", start, step)["mask"].alias("mask"),
    )

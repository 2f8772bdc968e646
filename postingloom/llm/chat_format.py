"""Dialogues for training, once from the side of every participant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import LAST_ID, numbered

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
#: Rows with the same turn of a conversation are dealt into so many groups, turns into steps of so many.
GROUPS, STEP = 64, 256


def _messages(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct messages with their place in the conversation."""
    messages = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.coalesce(F.col(turn).cast("long"), F.lit(LAST_ID)).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).distinct()
    dealt = (
        messages.withColumn("_step", F.floor(F.col("turn") / STEP))
        .withColumn("_fine", F.struct("turn", F.pmod(F.xxhash64("role", "text"), F.lit(GROUPS)).alias("bucket")))
        .withColumn(
            "_group", F.concat_ws("|", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), "turn", F.col("_fine.bucket"))
        )
    )
    return numbered(dealt, "conv_id", "_step", "_fine", "_group", ["role", "text"], "place").drop("_step", "_fine", "_group")


def _label(speaker: Column, perspective: Column, context: Sequence[str]) -> Column:
    return (
        F.when(speaker == perspective, F.lit("assistant"))
        .when(speaker.isin(*context), speaker)
        .otherwise(F.concat(F.lit("user name="), speaker))
    )


def perspectives(
    turns: DataFrame,
    context: Sequence[str] = ("system",),
    part_turns: int = 1024,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, perspective, part, n_turns, rendered, trained): each dialogue once for every participant.

    The participant speaks as the assistant, all others as users with their names, and the roles in
    ``context`` as themselves; those are no participants. trained lists the stretches (start, end) of rendered, in code points, that
    the participant has to learn: what it says and the mark that ends it.

    A dialogue of up to ``part_turns`` messages is one row per participant. Longer ones go on in further
    parts, counted from 0, so that no task has to hold a dialogue of any length. Messages are ordered by turn, a
    missing one last; those of the same turn by a hash of role and text. Repeated rows are one message. A missing role is
    called unknown, a missing text is empty, and rows without conv_id are one conversation. A conversation
    with context alone has no rows. Only the four columns are read, so further ones may have any name. No rows give no rows.
    """
    messages = _messages(turns, conv_id, turn, role, text)
    part = F.floor((F.col("place") - 1) / part_turns)
    # At most part_turns messages in a group.
    parts = (
        messages.withColumn("part", part)
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("messages"))
    )
    speakers = (
        turns.select(F.col(conv_id).alias("of_conv"), F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("perspective"))
        .where(~F.col("perspective").isin(*context))
        .distinct()
    )
    lines = F.transform(
        "messages",
        lambda m: F.struct(
            F.concat(F.lit(BEGIN), _label(m["role"], F.col("perspective"), context), F.lit("\n")).alias("head"),
            F.concat(m["text"], F.lit(END)).alias("body"),
            (m["role"] == F.col("perspective")).alias("own"),
        ),
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,`end`:int>>").alias("spans"))

    def place(state: Column, line: Column) -> Column:
        start = state["at"] + F.length(line["head"])
        end = start + F.length(line["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(line["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    rendered = F.transform(
        F.array(lines),
        lambda own: F.struct(
            F.array_join(F.transform(own, lambda line: F.concat(line["head"], line["body"])), "").alias("rendered"),
            F.aggregate(own, nothing, place, lambda state: state["spans"]).alias("trained"),
        ),
    )[0]
    return (
        parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv")))
        .withColumn("chat", rendered)
        .select("conv_id", "perspective", "part", F.size("messages").alias("n_turns"), "chat.rendered", "chat.trained")
    )

"""Preference formatting: one prompt, two masked completions.

The prompt is the longest common turn prefix of the chosen and the rejected conversation,
rendered once.  Each completion is the rest of its conversation; its mask lists the character
spans that count for the loss, the assistants' texts with their closing line break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strider.llm.common import running

TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order of turn, role and text.

    Null role or text counts as empty, a null turn number comes first, repeated rows stay
    repeated turns; rows without conv_id make one conversation without id.
    """
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("t")).select(
            "conv_id", F.transform("t", lambda x: F.struct(x["role"], x["text"])).cast(TURNS).alias("turns"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("\n"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that two conversations share."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("long")


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _mask(turns: Column) -> Column:
    """start:end of the assistants' texts in the rendered turns, comma-joined."""
    width = lambda t: F.length(t["role"]) + 5 + F.length(t["text"]) + 1
    starts = running(F.transform(turns, lambda t: width(t).cast("long")), lambda a, b: a + b)
    spans = F.zip_with(turns, starts, lambda t, at: F.when(t["role"] == "assistant", F.concat_ws(
        ":", (at + F.length(t["role"]) + 5).cast("string"), (at + width(t)).cast("string"))))
    return F.array_join(F.array_compact(spans), ",")


def preferences(pairs: DataFrame) -> DataFrame:
    """``pairs`` (pair_id, chosen, rejected: arrays of (role, text)) as training rows: pair_id,
    prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.

    A null conversation counts as empty.  Equal conversations give empty completions.
    """
    none = F.array().cast(TURNS)
    made = pairs.select("pair_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    made = made.withColumn("k", common_turns(F.col("c"), F.col("r")))
    rest = lambda name: F.slice(name, (F.col("k") + 1).cast("int"), F.greatest(F.size(name), F.lit(1)))
    made = made.select("pair_id", "k", F.slice("c", F.lit(1), F.col("k").cast("int")).alias("p"),
                       rest("c").alias("c"), rest("r").alias("r"))
    return made.select(
        "pair_id", F.col("k").alias("prompt_turns"), _text(F.col("p")).alias("prompt"),
        _text(F.col("c")).alias("chosen"), _text(F.col("r")).alias("rejected"),
        _mask(F.col("c")).alias("chosen_mask"), _mask(F.col("r")).alias("rejected_mask"))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Preference pairs out of plain conversations, one per conversation.

    Chosen is the conversation.  Rejected is what stands before its last assistant turn (or
    all of it, if there is none), answered with the last assistant turn of the neighbour whose
    conv_id differs in the lowest bit; an empty answer where there is none.
    """
    every = conversations(turns)
    last = F.array_max(F.transform(F.col("turns"), lambda t, i: F.when(t["role"] == "assistant", i + 1)))
    every = every.withColumn("last", last)
    reply = every.where("last is not null").select(
        F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"),
        F.element_at("turns", F.col("last").cast("int"))["text"].alias("reply"))
    context = F.when(F.col("last").isNull(), F.col("turns")).otherwise(
        F.slice("turns", F.lit(1), (F.coalesce("last", F.lit(1)) - 1).cast("int")))
    answer = F.struct(F.lit("assistant").alias("role"), F.coalesce("reply", F.lit("")).alias("text"))
    return every.join(reply, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"),
        F.concat(context, F.array(answer)).cast(TURNS).alias("rejected"))

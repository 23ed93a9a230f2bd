"""Preference formatting: one prompt and two masked completions per pair of conversations.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (same role and text, position by
position) is rendered once as the prompt; what follows on either side is its completion, with the code-point spans that
the loss covers: the text and end mark of assistant turns. Two equal conversations part before their last assistant turn, so
that something is left to prefer; if they have none, all of them is prompt and the completions are empty.

All of it is built-in functions over the turns. What comes out for a conversation is one text, so its turns come together in
one row; tasks share conversations evenly, but a single one is not split. Turns
are ordered by number, then role, then text; repeated turns are turns of their own. A NULL role is rendered as an empty
role, a NULL text as an empty text (and both differ from empty ones in no way); a conversation without turns on one side
gives an empty completion there; an empty table gives no pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def gathered(turns: DataFrame, key: str, name: str) -> DataFrame:
    """One row per conversation: its key, and its turns in order as structs of role and text."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.groupBy(key).agg(ordered.alias(name))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask(turns: Column) -> Column:
    """Spans of the assistant's text and end mark in the rendered turns, as [start, end) in code points."""
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def walk(done: Column, turn: Column) -> Column:
        start = done["at"] + F.length(F.concat(F.lit(START), turn["role"], F.lit(MIDDLE)))
        end = start + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")))
        spans = F.when(turn["role"] == TRAINED, F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, nothing, walk, lambda done: done["spans"])


def _last_reply(turns: str) -> Column:
    """Position of the last assistant turn; 0 if there is none."""
    return F.coalesce(F.array_max(F.transform(turns, lambda t, i: F.when(t["role"] == TRAINED, i + 1).otherwise(0))), F.lit(0)).cast("int")


def _common(chosen: str, rejected: str) -> Column:
    """How many turns both begin with."""
    shorter = F.least(F.size(chosen), F.size(rejected))
    longer = F.greatest(F.size(chosen), F.size(rejected))
    alike = F.zip_with(F.slice(chosen, F.lit(1), shorter), F.slice(rejected, F.lit(1), shorter), lambda a, b: a == b)
    first = F.array_position(alike, False)
    same = F.when(first > 0, first - 1).otherwise(shorter).cast("int")
    return F.when((same == longer) & (_last_reply(chosen) > 0), _last_reply(chosen) - 1).otherwise(same)


def format_preferences(pairs: DataFrame) -> DataFrame:
    """From pair_id, chosen and rejected (arrays of role and text) to pair_id, n_prompt_turns, prompt, and text and mask
    of both completions."""
    none = F.array().cast("array<struct<role:string,text:string>>")
    given = pairs.select("pair_id", *(F.coalesce(F.col(side), none).alias(side) for side in ("chosen", "rejected")))
    cut = given.withColumn("n_prompt_turns", _common("chosen", "rejected"))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_prompt_turns") + 1, F.size(side))

    parts = cut.select(
        "pair_id", "n_prompt_turns", F.slice("chosen", F.lit(1), F.col("n_prompt_turns")).alias("_prompt"),
        rest("chosen").alias("_chosen"), rest("rejected").alias("_rejected"),
    )
    return parts.select(
        "pair_id", "n_prompt_turns", render(F.col("_prompt")).alias("prompt"),
        render(F.col("_chosen")).alias("chosen"), mask(F.col("_chosen")).alias("chosen_mask"),
        render(F.col("_rejected")).alias("rejected"), mask(F.col("_rejected")).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs from unpaired conversations: pair_id, chosen and rejected, one pair for every conversation.

    Chosen is the conversation; rejected is the same with the last assistant reply of its neighbour (conversations 2k and
    2k + 1), an answer to something else, in the place of its own last one. Without a neighbour, or if that has no reply, the
    rejected reply is empty. A conversation without an assistant turn is chosen and rejected as it is. Turns without
    ``conv_id`` make one conversation, which has no neighbour.
    """
    found = gathered(turns, "conv_id", "chosen").withColumn("_last", _last_reply("chosen"))
    replies = found.where("_last > 0").select(
        (F.col("conv_id") + 1 - 2 * F.pmod("conv_id", F.lit(2))).alias("_for"), F.col("chosen")[F.col("_last") - 1]["text"].alias("_reply")
    )
    reply = F.struct(F.lit(TRAINED).alias("role"), F.coalesce("_reply", F.lit("")).alias("text"))
    swapped = F.transform("chosen", lambda t, i: F.when(i + 1 == F.col("_last"), reply).otherwise(t))
    paired = found.join(replies, found["conv_id"] == replies["_for"], "left")
    return paired.select(F.col("conv_id").alias("pair_id"), "chosen", swapped.alias("rejected"))

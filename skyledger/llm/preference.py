"""Preference pairs from chosen and rejected conversations.

The longest common prefix of turns becomes the prompt and is rendered once. What
follows in either conversation is its completion; a mask names the spans of the
completion that are learned, which are the assistant's texts with their end
marks. Only DataFrame functions are used.

Defined results: turns are ordered by number, then role, then text; repeated
rows of a conversation count once. A missing role is ``unknown``, a missing text
is empty. Every row without conv_id is a conversation of its own with a missing
id and no partner; such rows are not gathered. If a side has no turns its
completion is empty; if the sides are equal both completions are. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

END = "<|end|>\n"
LEARNED_ROLE = "assistant"


def _role_and_text() -> list[Column]:
    return [F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")]


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its ``turns`` (role, text) in order, of turns that have a conv_id."""
    numbered = F.struct("turn", *_role_and_text())
    known = turns.where("conv_id is not null")
    return known.groupBy("conv_id").agg(F.sort_array(F.collect_set(numbered)).alias("numbered")).select(
        "conv_id",
        F.transform("numbered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
    )


def lone_turns(turns: DataFrame) -> DataFrame:
    """Turns without conv_id in the shape of ``conversations``, each by itself."""
    return turns.where("conv_id is null").select("conv_id", F.array(F.struct(*_role_and_text())).alias("turns"))


def _with_last_answer(own: DataFrame) -> DataFrame:
    """Adds ``at``, the number of the last answer."""
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"]), LEARNED_ROLE).cast("int") + 1
    return own.withColumn("at", F.when(F.exists("turns", lambda t: t["role"] == LEARNED_ROLE), last))


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """(start, stop) of the learned characters in the rendered turns."""

    def add(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_header(turn))
        stop = start + F.length(turn["text"]) + len(END)
        span = F.struct(start.alias("start"), stop.alias("stop"))
        spans = F.when(turn["role"] == LEARNED_ROLE, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start:int,stop:int>>")
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda s: s["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are the same."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """From (pair_id, chosen, rejected), arrays of (role, text): prompt, completions and masks."""
    empty = F.array().cast("array<struct<role:string,text:string>>")
    split = pairs.select(
        "pair_id", F.coalesce("chosen", empty).alias("chosen"), F.coalesce("rejected", empty).alias("rejected")
    ).withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    rest = lambda side: F.slice(side, F.col("n_prompt_turns") + 1, F.greatest(F.size(side), F.lit(1)))
    return split.select(
        "pair_id", "n_prompt_turns",
        _render(F.slice("chosen", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
        rest("chosen").alias("c"), rest("rejected").alias("r"),
    ).select(
        "pair_id", "n_prompt_turns", "prompt", _render(F.col("c")).alias("chosen"), _mask(F.col("c")).alias("chosen_mask"),
        _render(F.col("r")).alias("rejected"), _mask(F.col("r")).alias("rejected_mask"),
    )


def answers_of_neighbours(turns: DataFrame) -> DataFrame:
    """Pairs for every conversation: itself, and itself with the neighbour's last answer in place of its own.

    Neighbours are conversations 2k and 2k + 1. Without a neighbour, or if that has
    no answer, the rejected side ends before the last answer; a conversation that
    has no answer is rejected as it is.
    """
    own = _with_last_answer(conversations(turns))
    answers = own.where("at is not null").select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("partner"), F.get("turns", F.col("at") - 1).alias("answer")
    )
    joined = own.join(answers, F.col("conv_id") == F.col("partner"), "left").drop("partner")
    # Missing ids stay out of the shuffles, where they would meet in one task.
    lone = _with_last_answer(lone_turns(turns))
    before = F.slice("turns", F.lit(1), F.col("at") - 1)
    other = F.when(F.col("answer").isNull(), before).otherwise(F.array_append(before, F.col("answer")))
    return joined.unionByName(lone, allowMissingColumns=True).select(
        F.col("conv_id").alias("pair_id"),
        F.col("turns").alias("chosen"),
        F.when(F.col("at").isNull(), F.col("turns")).otherwise(other).alias("rejected"),
    )


def mask_string(mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"], s["stop"])), ",")

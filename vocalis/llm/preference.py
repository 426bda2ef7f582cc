"""Preference pairs: shared prompt and masked chosen / rejected completions.

Chosen and rejected conversations of a pair are compared turn by turn; the
longest common prefix of (role, text) turns is rendered once as the prompt, the
rest of each side as its completion.  A mask lists the code-point spans of a
completion that are trained on: the texts of its assistant turns with their end
marker.

One conversation is gathered per row, which is what a pair renders to; rows are
grouped by pair, so pairs spread over all tasks and equal conversations are
never brought together.

Defined cases: turns are ordered by turn, role, text (nulls first); null role
renders as ``unknown``, null text as empty; repeated turns are turns of their
own; when both sides are equal the completions are empty; a pair with one side
only has ``paired`` false, its whole conversation as prompt and null
completions; null pair keys make one pair; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|turn|>", "\n", "<|end|>\n"


def _turns(side: DataFrame, pair: str, name: str) -> DataFrame:
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return side.groupBy(F.col(pair).alias(f"_{name}_key")).agg(F.transform(
        F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
        .alias(name))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn arrays."""
    same = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda z: z["a"].eqNullSafe(z["b"]))
    first = F.array_position(same, F.lit(False)).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.size(same))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), t["role"], F.lit(SEP), t["text"], F.lit(END))), "")


def trained_spans(turns: Column) -> Column:
    """(start, end) of the assistant texts with their end marker, in code points of ``render(turns)``."""
    def length(t: Column) -> Column:
        return F.char_length(t["role"]) + F.char_length(t["text"]) + len(START + SEP + END)

    spans = "array<struct<start:int,end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out"))

    def step(acc: Column, t: Column) -> Column:
        end = acc["at"] + length(t)
        start = acc["at"] + F.char_length(t["role"]) + len(START + SEP)
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["out"], one))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, zero, step, lambda acc: acc["out"])


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id") -> DataFrame:
    """pair, paired, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask.

    Both inputs have (pair, turn, role, text).
    """
    a, b = _turns(chosen, pair, "a"), _turns(rejected, pair, "b")
    both = a.join(b, F.col("_a_key").eqNullSafe(F.col("_b_key")), "full").select(
        F.coalesce("_a_key", "_b_key").alias(pair), "a", "b",
        (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("paired"))
    cut = both.select(pair, "paired", F.coalesce("a", "b").alias("a"), F.coalesce("b", "a").alias("b")) \
        .select(pair, "paired", "a", "b", common_turns(F.col("a"), F.col("b")).alias("n_common"))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_common") + 1, F.size(side))

    return cut.select(
        pair, "paired", "n_common", render(F.slice("a", F.lit(1), F.col("n_common"))).alias("prompt"),
        F.when(F.col("paired"), render(rest("a"))).alias("chosen"),
        F.when(F.col("paired"), render(rest("b"))).alias("rejected"),
        F.when(F.col("paired"), trained_spans(rest("a"))).alias("chosen_mask"),
        F.when(F.col("paired"), trained_spans(rest("b"))).alias("rejected_mask"))


def regenerated(conversations: DataFrame) -> DataFrame:
    """A rejected side for each conversation: cut at its last assistant turn, answered by the next conversation's.

    The next conversation is ``conv_id + 1``; without it, or without an assistant turn on either side, there is no
    rejected side.  The last assistant turn has the largest (turn, text).
    """
    convs = conversations.select("conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull())
    last = convs.where(F.col("role") == "assistant").groupBy("conv_id").agg(
        F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    other = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last.text").alias("other_text"))
    answer = last.join(other, "conv_id").select("conv_id", F.col("last.turn").alias("last_turn"), "other_text")
    kept = convs.join(answer, "conv_id").where(F.col("turn") < F.col("last_turn")) \
        .select("conv_id", "turn", "role", "text")
    return kept.unionByName(answer.select(
        "conv_id", F.col("last_turn").alias("turn"), F.lit("assistant").alias("role"), F.col("other_text").alias("text")))

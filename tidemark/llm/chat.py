"""Preference formatting of conversation pairs, with DataFrame functions only.

A pair is a chosen and a rejected conversation.  Their longest common prefix of
turns (equal role and text) is rendered once as the prompt; what follows on either
side is that side's completion, with a mask of the spans that a trainer should
learn: the assistants' text and its end mark.

Everything happens inside the row of a pair; the only shuffles build conversations
from turns and pair them by id, so no group but a conversation is ever collected.

Defined cases: a null role or text counts as empty; rows without a conversation id
are left out; repeated turns count once; turns that share a number follow each
other by role and text; identical sides give empty completions; a null or empty side
gives an empty prompt and an empty completion; texts are rendered whole, however long.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role: string, text: string>>"
MASK = "array<struct<start: int, stop: int>>"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(id, turns) from one row for each turn, in order of turn number."""
    turn = F.struct(F.col(turn_col).alias("at"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = F.array_sort(F.collect_set(turn))
    return turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(ordered.alias("turns")) \
        .select("id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def first_reply(turns: str) -> Column:
    """Position from 1 of the first assistant turn, 0 if there is none."""
    return F.array_position(F.transform(turns, lambda t: t["role"] == "assistant"), True).cast("int")


def swapped_pairs(convs: DataFrame) -> DataFrame:
    """(id, chosen, rejected): a conversation, and its opening answered by its neighbour's replies.

    The neighbour is the conversation whose id differs in the last bit; the pair has
    the turns before the first reply in common, and more if the replies agree.
    Without a neighbour that has a reply the rejected side ends after the opening.  A conversation without a
    reply is all opening: both sides are the whole of it.  Every conversation has a row.  Ids are whole numbers.
    """
    own = convs.withColumn("at", first_reply("turns"))
    other = own.where(F.col("at") > 0).select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"),
                                              F.slice("turns", F.col("at"), F.size("turns")).alias("replies"))
    answered = F.concat(F.slice("turns", F.lit(1), F.col("at") - 1), F.coalesce("replies", F.array().cast(TURNS)))
    return own.join(other, "id", "left").select(
        "id", F.col("turns").alias("chosen"), F.when(F.col("at") > 0, answered).otherwise(F.col("turns")).alias("rejected"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False).cast("int")
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b)))


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def rendered(turn: Column) -> Column:
    return F.concat(header(turn), turn["text"], F.lit("<|end|>\n"))


def text_of(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask_of(turns: Column) -> Column:
    """Code point spans of the assistants' text with its end mark, inside the rendered turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(MASK).alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        start, stop = acc["at"] + F.length(header(t)), acc["at"] + F.length(rendered(t))
        span = F.struct(start.alias("start"), (stop - 1).alias("stop"))
        return F.struct(stop.alias("at"), F.when(t["role"] == "assistant", F.array_append(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, zero, add, lambda acc: acc["spans"])


def format_preferences(pairs: DataFrame, id_col: str = "id", chosen_col: str = "chosen",
                       rejected_col: str = "rejected") -> DataFrame:
    """(id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask) for every pair."""
    none = F.array().cast(TURNS)
    rows = pairs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(chosen_col), none).alias("_a"),
                        F.coalesce(F.col(rejected_col), none).alias("_b")) \
        .withColumn("_n", common_turns(F.col("_a"), F.col("_b")))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("_n") + 1, F.size(side))

    return rows.select(
        F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_prompt_turns"),
        text_of(F.slice("_a", F.lit(1), F.col("_n"))).alias("prompt"),
        text_of(rest("_a")).alias("chosen"), text_of(rest("_b")).alias("rejected"),
        mask_of(rest("_a")).alias("chosen_mask"), mask_of(rest("_b")).alias("rejected_mask"))


def mask_text(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["start"].cast("string"), m["stop"].cast("string"))), ",")

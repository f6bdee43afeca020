"""Preference formatting: chosen and rejected conversations as prompt and completions.

The turns that both conversations begin with are rendered once, as the prompt; the
rest of each is its completion, with the parts that may be learned from (what the
assistant says, and its end mark) as spans. Built from expressions only, so the
formatting needs no shuffle and no Python. Gathering turns to conversations is one
shuffle; a group is one conversation, which is also one row of the result.

A null role counts as user, a null text as empty. Turns of equal number are ordered
by role and text. Turns without conv_id belong to no conversation. Where one
conversation begins with all of the other, the shorter one's completion is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
SPANS = "array<struct<start:long,end:long>>"
#: The role whose turns are learned from.
LEARNED = "assistant"
END = "<|end|>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def rendered(turns: Column) -> Column:
    """The turns as one text."""
    lines = F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(f"{END}\n")))
    return F.array_join(lines, "")


def learned_spans(turns: Column) -> Column:
    """Where the learned turns' texts and end marks stand in the rendered turns, in
    code points, ends exclusive."""

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.char_length(_head(turn))
        end = start + F.char_length(turn["text"]) + len(END)
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == LEARNED, F.concat(state["spans"], own.cast(SPANS)))
        return F.struct(
            (end + 1).alias("at"), F.coalesce(spans, state["spans"]).alias("spans")
        )

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(turns, begin, step, lambda state: state["spans"])


def common_turns(one: Column, other: Column) -> Column:
    """How many turns both begin with."""
    shorter = F.least(F.size(one), F.size(other))
    equal = F.zip_with(
        F.slice(one, 1, shorter),
        F.slice(other, 1, shorter),
        lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]),
    )
    differs = F.array_position(equal, False)
    return F.when(differs > 0, differs - 1).otherwise(shorter).cast("int")


def _without_nulls(turns: Column) -> Column:
    filled = F.transform(
        turns,
        lambda t: F.struct(
            F.coalesce(t["role"], F.lit("user")).alias("role"),
            F.coalesce(t["text"], F.lit("")).alias("text"),
        ),
    )
    return F.coalesce(filled, F.array().cast(TURNS))


def formatted(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """The other columns of ``pairs`` with prefix_turns, prompt, and for each side
    its completion and the spans of it to learn from. Columns named as the results
    are replaced."""
    made = ("prefix_turns", "prompt", "chosen_spans", "rejected_spans", chosen, rejected)
    rest = [F.col(f"`{c}`") for c in pairs.columns if c not in made]
    both = pairs.select(
        F.struct(*rest).alias("_rest"),
        _without_nulls(F.col(chosen)).alias("_c"),
        _without_nulls(F.col(rejected)).alias("_r"),
    ).withColumn("prefix_turns", common_turns(F.col("_c"), F.col("_r")))

    def after(turns: str) -> Column:
        return F.slice(turns, F.col("prefix_turns") + 1, F.size(turns))

    return both.select(
        "_rest.*",
        "prefix_turns",
        rendered(F.slice("_c", 1, F.col("prefix_turns"))).alias("prompt"),
        rendered(after("_c")).alias("chosen"),
        learned_spans(after("_c")).alias("chosen_spans"),
        rendered(after("_r")).alias("rejected"),
        learned_spans(after("_r")).alias("rejected_spans"),
    )


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) from (conv_id, turn, role, text)."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    bare = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return (
        turns.where("conv_id is not null")
        .groupBy("conv_id")
        .agg(bare.alias("turns"))
        .select("conv_id", _without_nulls(F.col("turns")).alias("turns"))
    )


def against_repetition(conversations: DataFrame) -> DataFrame:
    """Pairs (conv_id, chosen, rejected) that teach not to repeat oneself.

    Chosen is a conversation up to its last reply; rejected gives the reply before
    that once more, or none where there is no other. Conversations without a reply
    make no pair.
    """
    replies = F.filter(
        F.transform("turns", lambda t, i: F.when(t["role"] == LEARNED, i + 1)),
        lambda i: i.isNotNull(),
    )
    last = F.element_at("replies", -1)
    before = F.when(F.size("replies") > 1, F.get("turns", F.get("replies", F.size("replies") - 2) - 1)["text"])
    repeated = F.struct(F.lit(LEARNED).alias("role"), F.coalesce(before, F.lit("")).alias("text"))
    return (
        conversations.withColumn("replies", replies)
        .where(F.size("replies") > 0)
        .select(
            "conv_id",
            F.slice("turns", 1, last).alias("chosen"),
            F.concat(F.slice("turns", 1, last - 1), F.array(repeated)).alias("rejected"),
        )
    )

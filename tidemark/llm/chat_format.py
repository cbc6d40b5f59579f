"""Preference formatting: the turns that a chosen and a rejected conversation share become one prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Marks of a rendered turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
#: Roles whose text is trained on.
TRAINED_ROLE = "assistant"
_TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its (role, text) in order of turn, then role, then text.

    Nulls in role and text count as empty. A conversation is rendered as one text, so its turns must meet in one row.
    """
    row = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    listed = F.sort_array(F.collect_list(row))
    return turns.groupBy("conv_id").agg(
        F.transform(listed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def shared_turns(chosen: Column, rejected: Column) -> Column:
    """Number of turns at the start that are equal in role and text."""
    equal = F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    return F.coalesce(F.nullif(F.array_position(equal, False), F.lit(0)) - 1, F.size(equal).cast("long")).cast("int")


def _render(turn: Column) -> Column:
    return F.concat(F.lit(TURN_START), turn["role"], F.lit("\n"), turn["text"], F.lit(TURN_END + "\n"))


def render(turns: Column) -> Column:
    """Turns as one text."""
    return F.array_join(F.transform(turns, _render), "")


def trained_spans(turns: Column) -> Column:
    """start:end in code points, end exclusive, of the trained turns' text and end mark in the rendered text."""
    head = F.length(F.lit(TURN_START))

    def step(acc: Column, turn: Column) -> Column:
        start = acc["at"] + head + F.length(turn["role"]) + 1
        end = start + F.length(turn["text"]) + len(TURN_END)
        spans = F.when(
            turn["role"] == TRAINED_ROLE,
            F.concat(acc["spans"], F.array(F.concat_ws(":", start.cast("string"), end.cast("string")))),
        ).otherwise(acc["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, first, step, lambda acc: F.array_join(acc["spans"], ","))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """The rows (with `chosen` and `rejected`, arrays of (role, text)) as prompt, paired completions and masks.

    The longest common prefix of turns is rendered once as `prompt`; what follows on either side is its completion, and
    `*_mask` lists the spans of the completion that are trained on: the assistant's words and end marks. Equal
    conversations leave empty completions and masks. A null side counts as no turns. Other columns are carried along.
    """
    none = F.array().cast(_TURNS)
    rows = pairs.withColumn("chosen", F.coalesce("chosen", none)).withColumn("rejected", F.coalesce("rejected", none))
    rows = rows.withColumn("n_shared", shared_turns(F.col("chosen"), F.col("rejected")))
    for side in ("chosen", "rejected"):
        rows = rows.withColumn(f"_{side}", F.slice(side, F.col("n_shared") + 1, F.size(side)))
    rows = rows.withColumn("_prompt", F.slice("chosen", 1, F.col("n_shared")))
    return (
        rows.withColumn("prompt", render(F.col("_prompt")))
        .withColumn("chosen", render(F.col("_chosen")))
        .withColumn("rejected", render(F.col("_rejected")))
        .withColumn("chosen_mask", trained_spans(F.col("_chosen")))
        .withColumn("rejected_mask", trained_spans(F.col("_rejected")))
        .drop("_prompt", "_chosen", "_rejected")
    )


def with_cut_answer(convs: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: the rejected side ends the last answer after half of its words.

    Words are what stands between single spaces. Conversations without an answer get two equal sides.
    """
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i).otherwise(-1)))

    def cut(turn: Column, i: Column) -> Column:
        words = F.split(turn["text"], " ")
        half = F.array_join(F.slice(words, 1, F.floor(F.size(words) / 2).cast("int")), " ")
        return F.struct(turn["role"].alias("role"), F.when(i == F.col("_last"), half).otherwise(turn["text"]).alias("text"))

    rows = convs.withColumn("_last", last)
    return rows.select("conv_id", F.col("turns").alias("chosen"), F.transform("turns", cut).alias("rejected"))

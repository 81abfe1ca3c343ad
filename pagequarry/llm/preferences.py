"""Preference pairs: the turns both conversations share become the prompt, the rest two masked completions.

Built of DataFrame functions only. Turns of both sides meet by pair and turn
number; the lowest number at which they differ ends the shared prefix. Texts are
put together in two levels, first blocks of BLOCK_TURNS turns, then the blocks,
so that no task gathers the single turns of one very long conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TURNS = 64
# How a turn is written: <|role|>, a line end, the text, <|end|>, a line end.
_OPEN, _CLOSE = ("<|", "|>\n"), "<|end|>\n"
TRAINED_ROLE = "assistant"


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(_OPEN[0]), role, F.lit(_OPEN[1]), text, F.lit(_CLOSE))


def _turns(conversations: DataFrame, side: str) -> DataFrame:
    """Turns of one side; of turns with the same pair and number the least by role and text counts."""
    return (
        conversations.filter("pair_id IS NOT NULL AND turn IS NOT NULL")
        .groupBy(F.col("pair_id").cast("bigint").alias("pair_id"), F.col("turn").cast("bigint").alias("turn"))
        .agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias(side))
    )


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair: ``pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    Both inputs have pair_id, turn, role, text; turns are in the order of
    their numbers. ``prompt`` is the longest common prefix of turns (same
    number, role and text), rendered once; ``chosen`` and ``rejected`` are what
    each side adds, and a mask holds the ranges start:end (code points of the
    completion, end exclusive, comma-joined) that are trained on: texts of
    assistant turns with their end mark. A side without own turns has an empty
    completion and mask, a pair known to one side only an empty prompt. Null
    roles and texts count as empty, rows without pair_id or turn are left out,
    and of rows that repeat a turn one counts. Other columns are not read.
    """
    both = _turns(chosen, "c").join(_turns(rejected, "r"), ["pair_id", "turn"], "full_outer")
    ends = both.groupBy("pair_id").agg(F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("differs"))
    placed = both.join(ends, "pair_id").withColumn("shared", F.coalesce(F.col("turn") < F.col("differs"), F.lit(True)))
    pieces = [
        ("prompt", F.when(F.col("shared"), F.col("c"))),
        ("chosen", F.when(~F.col("shared"), F.col("c"))),
        ("rejected", F.when(~F.col("shared"), F.col("r"))),
    ]
    turn = F.struct("turn", *(
        F.struct(
            F.coalesce(rendered_turn(piece["role"], piece["text"]), F.lit("")).alias("text"),
            # Where the trained text begins; null if the turn is not trained on.
            F.when(piece["role"] == TRAINED_ROLE, F.char_length(piece["role"]) + len("".join(_OPEN))).alias("open"),
        ).alias(name)
        for name, piece in pieces
    ))
    blocks = (
        placed.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
        .groupBy("pair_id", "block")
        .agg(F.sum(F.col("shared").cast("bigint")).alias("n"), F.array_sort(F.collect_list(turn)).alias("turns"))
    )
    # Within a block: text and ranges from its own start.
    for name, _ in pieces:
        own = _each("turns", name)
        blocks = blocks.withColumn(name, F.array_join(F.transform(own, lambda t: t["text"]), "")).withColumn(f"{name}_ranges", _ranges(own))
    names = [column for name, _ in pieces for column in (name, f"{name}_ranges")]
    whole = blocks.groupBy("pair_id").agg(
        F.sum("n").alias("n_prompt_turns"), F.array_sort(F.collect_list(F.struct("block", *names))).alias("blocks")
    )
    columns = [F.array_join(_each("blocks", name), "").alias(name) for name, _ in pieces]
    masks = [_mask(name).alias(f"{name}_mask") for name in ("chosen", "rejected")]
    return whole.select("pair_id", "n_prompt_turns", *columns, *masks)


def _each(rows: str, name: str) -> Column:
    """The field ``name`` of every element of an array of structs."""
    return F.transform(rows, lambda row: row[name])


def _ranges(turns: Column) -> Column:
    """Trained ranges of rendered turns (text, open), counted from the first one's start."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("ranges"))

    def add(state: Column, turn: Column) -> Column:
        at, length = state["at"], F.char_length(turn["text"])
        # The line end after the end mark is not trained on.
        own = F.array(F.struct((at + turn["open"]).alias("a"), (at + length - 1).alias("b")))
        return F.struct((at + length).alias("at"), F.when(turn["open"].isNotNull(), F.concat(state["ranges"], own)).otherwise(state["ranges"]).alias("ranges"))

    return F.aggregate(turns, start, add, lambda state: state["ranges"])


def _mask(name: str) -> Column:
    """Ranges of all blocks, each moved by the length of the texts before its block, as text."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(state: Column, block: Column) -> Column:
        at = state["at"]
        moved = F.transform(block[f"{name}_ranges"], lambda r: F.concat_ws(":", r["a"] + at, r["b"] + at))
        return F.struct((at + F.char_length(block[name])).alias("at"), F.concat(state["parts"], moved).alias("parts"))

    return F.aggregate("blocks", start, add, lambda state: F.array_join(state["parts"], ","))


def neighbour_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from plain ``conversations`` (conv_id, turn, role, text).

    A conversation up to its last assistant turn is chosen; rejected is the
    same with that turn's text replaced by the last assistant text of
    conversation conv_id + 1, or without that turn where there is none.
    Conversations without an assistant turn make no pair.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("pair_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    last = (
        rows.filter((F.col("role") == TRAINED_ROLE) & F.col("pair_id").isNotNull() & F.col("turn").isNotNull())
        .groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("reply"))
    )
    other = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("reply.text").alias("other"), F.lit(True).alias("there"))
    cut = rows.join(last.select("pair_id", F.col("reply.turn").alias("end")).join(other, "pair_id", "left"), "pair_id").filter("turn <= end")
    columns = ("pair_id", "turn", "role", "text")
    rejected = cut.filter("turn < end OR there").withColumn("text", F.when(F.col("turn") == F.col("end"), F.col("other")).otherwise(F.col("text")))
    return cut.select(*columns), rejected.select(*columns)

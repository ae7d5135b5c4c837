"""Preference formatting: pairs of conversations as one prompt and two masked completions.

The turns that chosen and rejected share from the start are the prompt and are rendered once. What
follows in either is its completion; only assistant turns of a completion carry loss. The result has
a row for each rendered turn instead of one text for each pair, so a conversation of any number of
turns is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = -(2**63)


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def preferences(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, role, rendered, loss, first_difference.

    Reads conv_id, turn, role and text; ``pair`` is the pair of a row's conversation and ``chosen``
    whether it is the preferred one. Turns are ordered by their number, a null one first. A turn
    number belongs to the common prefix if all its rows are equal on both sides and so are all before
    it; equal rows of one conversation and turn count once, different ones are ordered by role and
    text. first_difference is the turn at which the completions begin, null if the sides are equal (or
    differ at a null turn). Null roles and texts equal each other and are rendered empty. A pair of which one side is
    missing has an empty prompt. Rows without a pair are left out. An empty table gives an empty
    result.
    """
    sides = turns.select(
        pair.cast("long").alias("pair_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(FIRST)).alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
        chosen.alias("chosen"),
    ).where("pair_id is not null")
    distinct = sides.groupBy("pair_id", "turn", "role", "text").agg(
        F.bool_or("chosen").alias("in_chosen"), F.bool_or(~F.col("chosen")).alias("in_rejected")
    )
    differs = F.when(~(F.col("in_chosen") & F.col("in_rejected")), F.col("turn"))
    cuts = distinct.groupBy("pair_id").agg(F.min(differs).alias("cut"))
    # A pair with very many turns is a hot key of this join; adaptive execution splits it.
    placed = distinct.join(cuts, "pair_id")
    shared = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(
        F.filter(F.array(F.when(F.col("in_chosen"), F.lit("chosen")), F.when(F.col("in_rejected"), F.lit("rejected"))), lambda x: x.isNotNull())
    )
    exploded = placed.withColumn("part", F.explode(parts))
    loss = (F.col("part") != "prompt") & F.coalesce(F.col("role") == "assistant", F.lit(False))
    return exploded.select(
        "pair_id",
        "part",
        F.when(F.col("turn") != FIRST, F.col("turn")).alias("turn"),
        "role",
        rendered(F.col("role"), F.col("text")).alias("rendered"),
        loss.alias("loss"),
        F.when(F.col("cut") != FIRST, F.col("cut")).alias("first_difference"),
    )


def neighbouring(conv_id: str = "conv_id") -> tuple[Column, Column]:
    """Conversations 2n and 2n + 1 are pair n; the even one is chosen."""
    return F.expr(f"{conv_id} div 2"), F.pmod(F.col(conv_id), F.lit(2)) == 0

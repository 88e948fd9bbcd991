"""Operator 7: chat formatting with cumulative-snapshot collapse. DataFrame functions only.

Chat logs often hold a conversation several times, each snapshot a prefix of a later one. Every turn gets a rolling hash of the turns
up to it; a conversation whose last hash is the hash of an earlier turn of another conversation is a snapshot, and an anti-join drops
it. Of equal conversations the one with the smallest conv_id stays. What remains is rendered.

The rolling hash is a running sum of hashes of (place, role, text). Places and sums are found in two levels, within slices of
SLICE turn numbers and then over slices, so a conversation with a third of all rows is spread over tasks. Rendered text is cut into parts of at
most PART turns, so no row or group grows with a conversation.

Edge cases: a null role is rendered as 'user', a null text as empty, and both hash apart from the values they are rendered like; a null
conv_id is one conversation; turns with a null number come last; turns with equal numbers follow by role and text; an empty table gives an
empty result; other columns are ignored. Hashes are 64 bits wide, twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

SLICE = 256
PART = 512


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, place (from 0), h1, h2 (rolling hashes up to and with this turn)."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.withColumn("slice", F.coalesce(F.floor(F.col("turn") / SLICE), F.lit(2**62)).cast("long"))
    slices = rows.groupBy("conv_id", "slice").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("conv_id", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "slice").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last())
    key = rows["conv_id"].eqNullSafe(F.col("c")) & (rows["slice"] == F.col("s"))
    placed = rows.join(starts.select(F.col("conv_id").alias("c"), F.col("slice").alias("s"), "start"), key).drop("c", "s")
    placed = placed.withColumn("place", F.col("start") + F.row_number().over(inside) - 1)
    said = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    # shifted so that sums of up to 2 ** 20 of them stay within 64 bits are exact in any order; beyond that decimal sums carry on
    one = lambda salt: F.xxhash64(F.lit(salt), *said).cast("decimal(38,0)")
    return placed.withColumn("a", one(1)).withColumn("b", one(2))


def maximal(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(turns with places, conv_id of the conversations that stay, with copies and n_turns)."""
    turns = scratch.write(_turns(conversations))
    sums = turns.groupBy("conv_id", "slice").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    bases = sums.select(F.col("conv_id").alias("c"), F.col("slice").alias("s"), F.coalesce(F.sum("a").over(earlier), zero).alias("a0"), F.coalesce(F.sum("b").over(earlier), zero).alias("b0"))
    running = Window.partitionBy("conv_id", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = turns.select("conv_id", "slice", "place", F.sum("a").over(running).alias("a"), F.sum("b").over(running).alias("b"))
    rolled = rolled.join(bases, rolled["conv_id"].eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")))
    rolled = scratch.write(rolled.select("conv_id", "place", F.xxhash64(F.col("a") + F.col("a0"), "place").alias("h1"), F.xxhash64(F.lit(7), F.col("b") + F.col("b0"), "place").alias("h2")))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    last = rolled.join(sizes.select(F.col("conv_id").alias("c"), "n_turns"), rolled["conv_id"].eqNullSafe(F.col("c")) & (F.col("place") == F.col("n_turns") - 1)).select("conv_id", "n_turns", "h1", "h2")
    ends = last.groupBy("h1", "h2", "n_turns").agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id"))["conv_id"].alias("conv_id"), F.count("*").alias("copies"))
    # a turn that is not the last of its conversation: who ends with its hash is a snapshot of that conversation
    inner = rolled.join(sizes.select(F.col("conv_id").alias("c"), "n_turns"), rolled["conv_id"].eqNullSafe(F.col("c")) & (F.col("place") < F.col("n_turns") - 1), "left_semi").select("h1", "h2").distinct()
    return turns, scratch.write(ends.join(inner, ["h1", "h2"], "left_anti").select("conv_id", "n_turns", "copies"))


def render(conversations: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, part (from 0), n_turns (of the conversation), copies (equal conversations, itself included), text.

    Each turn is '<|role|>' + newline + text + newline + '<|end|>' + newline; a conversation's text is its parts in order.
    """
    scratch = Scratch(conversations.sparkSession)
    turns, stay = maximal(conversations, scratch)
    kept = turns.join(stay.select(F.col("conv_id").alias("c"), "n_turns", "copies"), turns["conv_id"].eqNullSafe(F.col("c")))
    said = F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    rows = kept.select("conv_id", F.floor(F.col("place") / part).cast("int").alias("part"), "n_turns", "copies", F.struct("place", said.alias("said")).alias("x"))
    groups = rows.groupBy("conv_id", "part", "n_turns", "copies").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return groups.select("conv_id", "part", "n_turns", "copies", F.array_join(F.transform("x", lambda t: t["said"]), "").alias("text"))

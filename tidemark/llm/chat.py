"""Chat formatting after collapsing cumulative snapshots.

Loggers often store a conversation again after each turn, so one conversation appears as many
logged ones, each a prefix of the next. A turn's hash covers its place, role and text; the rolling
hash of a prefix is the exclusive-or of its turns' hashes (two seeds, 128 bits), so it is a running
aggregate and its whole-conversation form combines before the shuffle. Conversations whose whole
hash is the prefix hash of a longer one are removed by an anti-join, and of equal conversations
the smallest id stays. Only then is text rendered.

Nulls: rows without a conversation id are left out of every conversation; a null role is "user",
a null text is empty, a null turn sorts first. Turns that share a number are ordered by role and
text; rows that repeat exactly count once. An empty table gives no rows. Only the four named
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import kept

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, role, text): turns in order, numbered from 1, exact repeats taken once."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    plain = conversations.where("conv_id is not null").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return plain.distinct().select(
        "conv_id", F.row_number().over(order).alias("n"), "role", "text"
    )


def _hashes() -> list[Column]:
    tagged = [F.col("n"), F.col("role"), F.col("text")]
    return [
        F.xxhash64(F.lit(1), *tagged).alias("a"),
        F.xxhash64(F.lit(2), F.col("text"), F.col("role"), F.col("n")).alias("b"),
    ]


def prefixes(numbered: DataFrame) -> DataFrame:
    """(conv_id, n, a, b): the rolling hash of the first n turns of each conversation."""
    order = Window.partitionBy("conv_id").orderBy("n")
    return numbered.select("conv_id", "n", *_hashes()).select(
        "conv_id", "n", F.bit_xor("a").over(order).alias("a"), F.bit_xor("b").over(order).alias("b")
    )


def maximal(rolling: DataFrame) -> DataFrame:
    """(conv_id, n): the conversations that are no proper prefix of another, equal ones once.

    What is compared is one row per distinct prefix and one per distinct conversation, both
    combined before their shuffle: a first turn shared by a third of all rows becomes one row a
    task.
    """
    last = Window.partitionBy("conv_id")
    marked = kept(rolling.withColumn("size", F.max("n").over(last)), "turn-prefixes")
    whole = marked.where("n = size").groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    inner = marked.where("n < size").select("n", "a", "b").distinct()
    return whole.join(inner, ["n", "a", "b"], "left_anti").select("conv_id", F.col("n").alias("n_turns"))


def render(numbered: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text): the chosen conversations as one chat-markup text each."""
    line = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(CLOSE + "\n"))
    parts = numbered.join(chosen, "conv_id").groupBy("conv_id", "n_turns").agg(
        F.sort_array(F.collect_list(F.struct("n", line.alias("line")))).alias("parts")
    )
    return parts.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.array_join(F.col("parts.line"), "").alias("text"),
    )


def chat_format(conversations: DataFrame) -> DataFrame:
    """Maximal conversations of a log, rendered."""
    numbered = kept(turns(conversations), "turns")
    return render(numbered, maximal(prefixes(numbered)))

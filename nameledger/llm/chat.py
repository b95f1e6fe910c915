"""Chat formatting of logged conversations, after snapshots that others go on from are taken out.

A log that stores a conversation after each turn holds many that are only the beginning of a later one. Each turn adds
its hash to that of the turns before it, so every prefix of a conversation has one 128-bit hash; a conversation whose
whole hash is the hash of a longer one's prefix is left out by an anti-join, and of equal ones the least id stays. Equal
conversations and equal prefixes are folded before anything is joined: a first turn that all share is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nameledger.llm.common import written

UNKNOWN_ROLE = "unknown"


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(UNKNOWN_ROLE)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _hashes(position: Column) -> list[Column]:
    return [F.xxhash64(F.lit(salt), position, "role", F.lit("\n"), "text") for salt in (1, 2)]


def collapse_snapshots(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and, for turns without a conversation, loose: one row per maximal conversation.

    Turns stand in the order of turn, then role, then text; a null turn number comes first, a null role is
    ``unknown``, a null text is empty, and repeated rows are turns of their own. A turn without a conv_id is a
    conversation of one turn: it is kept, with its text in ``loose``, if no other conversation is equal or begins so.
    """
    turns = _turns(conversations)
    numbered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = numbered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.where("conv_id IS NOT NULL").withColumn("at", F.row_number().over(numbered))
    one, two = _hashes(F.col("at"))
    marks = written(
        placed.withColumns({"one": one, "two": two})
        .withColumns({"one": F.bit_xor("one").over(so_far), "two": F.bit_xor("two").over(so_far)})
        .select("conv_id", "at", "one", "two", F.count("*").over(Window.partitionBy("conv_id")).alias("n")),
        "turns",
    )
    loose_one, loose_two = _hashes(F.lit(1))
    loose = turns.where("conv_id IS NULL").select(
        F.lit(None).cast("bigint").alias("conv_id"), loose_one.alias("one"), loose_two.alias("two"), F.lit(1).cast("bigint").alias("n"),
        rendered_turn(F.col("role"), F.col("text")).alias("loose"),
    )
    whole = marks.where("at = n").select("conv_id", "one", "two", "n", F.lit(None).cast("string").alias("loose"))
    classes = (
        whole.unionByName(loose)
        .groupBy("one", "two", "n")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"), F.min("loose").alias("loose"))
    )
    prefixes = marks.where("at < n").select("one", "two", F.col("at").cast("bigint").alias("n")).distinct()
    maximal = classes.join(prefixes, ["one", "two", "n"], "left_anti")
    text = F.when(F.col("conv_id").isNull(), F.col("loose"))
    return maximal.select("conv_id", F.col("n").alias("n_turns"), "n_copies", text.alias("loose"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and rendered: the maximal conversations as one text each.

    Reads conv_id, turn, role and text, other columns are passed over; nulls and repeats as in
    ``collapse_snapshots``. Only turns of conversations that stay are gathered.
    """
    kept = written(collapse_snapshots(conversations), "maximal")
    turns = _turns(conversations).join(kept.where("conv_id IS NOT NULL").select("conv_id"), "conv_id", "left_semi")
    texts = (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .select("conv_id", F.array_join(F.transform("turns", lambda t: rendered_turn(t["role"], t["text"])), "").alias("rendered"))
    )
    named = kept.where("conv_id IS NOT NULL").drop("loose").join(texts, "conv_id")
    return named.unionByName(kept.where("conv_id IS NULL").withColumnRenamed("loose", "rendered"))

"""Chat formatting: cumulative snapshots collapse to maximal conversations.

A logged conversation is often the beginning of a longer one. Every turn gets
the hash of all turns up to it (rolling, position-tagged, 2 x 64 bit). A
conversation whose full hash is some other's proper prefix hash is dropped by
an anti join; of equal conversations the smallest id stays. The rest are
rendered.

Positions and rolling hashes are computed per block of turn numbers and then
offset by per-block sums, so one very long conversation is spread over tasks;
rendered text is cut into parts of a fixed number of turns for the same
reason. Hashes are made distinct before the anti join, so a first turn or a
conversation that a third of all rows share is one row there.

Defined cases: exact repeats of a turn (same id, number, role, text) count
once; other turns with one number are ordered by role, then text, nulls first;
a null conversation id is an id like any other and sorts last; null roles
render as ``unknown`` and null texts as empty; an empty table gives an empty
result; other columns are ignored. Hash equality stands for text equality
(128 bits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import col

#: Turn numbers per block; also turns per rendered part.
BLOCK_TURNS = 256


def render_turn(role: Column, text: Column) -> Column:
    """One turn; markers inside the text lose their meaning."""
    body = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), body, F.lit("<|end|>\n"))


def prefix_hashes(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Per distinct turn: conv, turn, role, text, position (from 1), n_turns, prefix hashes p1, p2, full hashes f1, f2."""
    turns = df.select(
        col(id_col).alias("conv"), col(turn_col).alias("turn"), col(role_col).alias("role"), col(text_col).alias("text")
    ).distinct()
    # Nulls are keys too, so they are joined by a string that tells them apart.
    turns = turns.withColumn(
        "key", F.coalesce(F.concat(F.lit("c"), F.col("conv").cast("string")), F.lit("null"))
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))))
    in_block = Window.partitionBy("key", "block").orderBy(
        F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")
    )
    turns = turns.withColumn("local", F.row_number().over(in_block))
    sizes = turns.groupBy("key", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key")
    offsets = sizes.select(
        "key", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(whole).alias("n_turns")
    )
    turns = turns.join(offsets, ["key", "block"]).withColumn("position", F.col("offset") + F.col("local"))
    parts = ["position", F.isnull("role"), "role", F.isnull("text"), "text"]
    turns = turns.withColumn("h1", F.xxhash64(*parts)).withColumn("h2", F.xxhash64(F.lit("b"), *reversed(parts)))
    running = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = turns.groupBy("key", "block").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    zero = F.lit(0).cast("bigint")
    bases = sums.select(
        "key",
        "block",
        *[F.coalesce(F.bit_xor(f"x{i}").over(before), zero).alias(f"b{i}") for i in (1, 2)],
        *[F.bit_xor(f"x{i}").over(whole).alias(f"f{i}") for i in (1, 2)],
    )
    return (
        turns.withColumn("r1", F.bit_xor("h1").over(running))
        .withColumn("r2", F.bit_xor("h2").over(running))
        .join(bases, ["key", "block"])
        .select(
            "key", "conv", "turn", "role", "text", "position", "n_turns", "f1", "f2",
            F.col("r1").bitwiseXOR(F.col("b1")).alias("p1"),
            F.col("r2").bitwiseXOR(F.col("b2")).alias("p2"),
        )
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(key, n_copies) of the conversations that no longer one begins with."""
    full = turns.filter(F.col("position") == 1).select("key", "conv", "n_turns", "f1", "f2")
    distinct = full.groupBy("n_turns", "f1", "f2").agg(
        F.min(F.struct(F.col("conv").isNull().alias("missing"), "conv", "key")).alias("stays"),
        F.count("*").alias("n_copies"),
    )
    prefixes = (
        turns.filter(F.col("position") < F.col("n_turns"))
        .select(F.col("position").alias("n_turns"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
        .distinct()
    )
    return distinct.join(prefixes, ["n_turns", "f1", "f2"], "left_anti").select("stays.key", "n_copies")


def format_conversations(
    df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, part_turns: int = BLOCK_TURNS
) -> DataFrame:
    """Rendered maximal conversations: conv_id, part (from 0), n_turns, n_copies, text.

    A conversation of up to ``part_turns`` turns is one row; the parts of a
    longer one, put together in order, are its text.
    """
    turns = prefix_hashes(df, id_col, turn_col, role_col, text_col)
    kept = maximal_conversations(turns)
    part = F.floor((F.col("position") - 1) / part_turns)
    return (
        turns.join(kept, "key")
        .withColumn("part", part)
        .withColumn("said", F.struct("position", render_turn(F.col("role"), F.col("text")).alias("text")))
        .groupBy("key", "part")
        .agg(
            F.first("conv").alias("conv_id"),
            F.first("n_turns").alias("n_turns"),
            F.first("n_copies").alias("n_copies"),
            F.array_join(F.transform(F.array_sort(F.collect_list("said")), lambda x: x["text"]), "").alias("text"),
        )
        .select("conv_id", "part", "n_turns", "n_copies", "text")
    )

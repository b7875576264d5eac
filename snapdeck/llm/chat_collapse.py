"""Chat formatting with cumulative-snapshot collapse (operator 1), in SQL
functions only.

A chat log holds snapshots: a conversation is logged again with each turn
added. Each prefix of a conversation gets a rolling hash: the xor of the
hashes of (position, role, text) so far, in two lanes of 64 bits. Equal whole
conversations become one, kept under the smallest id. Then one that is equal
to a proper prefix of a longer one is removed by an anti-join on (length,
hash). What stays is maximal, and is rendered.

A conversation may be of any length: turns are worked on in blocks of turn
numbers, and a block that has more turns than numbers (null or repeated ones)
in blocks by position, ranked without bringing a conversation into one task.
Only block totals meet by conversation. A rendered conversation has one part
for each block of turns, in order; parts joined are the whole.

Defined results: null role and null text differ from empty ones in the
comparison; rendered, a null role is "unknown", a null text is empty. Turns
are in order of turn number (nulls first); equal numbers by role and text
hash, each row a turn. Rows with a null conversation id are one conversation.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from snapdeck.llm._common import fits_broadcast, stage
from snapdeck.operators.ranking import row_number_within

#: Turn numbers of one block, and most turns of a block and of a rendered part.
BLOCK_TURNS = 256
BROADCAST_BYTES = 64 << 20


def _hash(lane: str) -> Column:
    null = lambda c: F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1"))
    return F.xxhash64(F.lit(lane), null("role"), "role", null("text"), "text")


def _turns(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, block: int) -> DataFrame:
    named = df.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    return named.select(
        "*",
        F.coalesce(F.col("conv_id").cast("string"), F.lit("\0null")).alias("key"),
        F.coalesce(F.floor(F.col("turn") / block).cast("long"), F.lit(-(1 << 60))).alias("block"),
        _hash("1").alias("h1"),
        _hash("2").alias("h2"),
    )


_ORDER = ("turn", "h1", "h2")


def _in_blocks(turns: DataFrame, block: int) -> DataFrame:
    """``block`` as (block of numbers, block of positions in it), and ``nth``,
    the position in that. Equal turns are told apart by a row number, so that
    many of them don't meet in one task either."""
    rows = turns.withColumn("row", F.monotonically_increasing_id())
    ranked = row_number_within(rows, ["key", "block"], [F.col(c) for c in (*_ORDER, "row")], name="rank").drop("row")
    at = F.col("rank") - 1
    return ranked.withColumns(
        {"block": F.struct("block", F.floor(at / block).cast("long").alias("sub")), "nth": F.pmod(at, F.lit(block)) + 1}
    ).drop("rank")


def maximal(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK_TURNS,
) -> DataFrame:
    """(key, conv_id, n_turns, n_copies) of each conversation that is kept."""
    turns = _in_blocks(_turns(df, id_col, turn_col, role_col, text_col, block).select("key", "conv_id", "block", *_ORDER), block)
    before = W.partitionBy("key").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = turns.groupBy("key", "block").agg(F.count("*").alias("n")).select(
        "key", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    placed = turns.join(offsets, ["key", "block"]).withColumn("pos", F.col("offset") + F.col("nth"))
    so_far = W.partitionBy("key", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    rolled = stage(
        placed.select(
            "key",
            "conv_id",
            "block",
            "pos",
            F.bit_xor(F.xxhash64("pos", "h1")).over(so_far).alias("x1"),
            F.bit_xor(F.xxhash64("pos", "h2", F.lit("2"))).over(so_far).alias("x2"),
        ),
        "chat-prefixes",
    )
    # block totals, and what comes before each block
    last = rolled.groupBy("key", "block").agg(
        F.first("conv_id").alias("conv_id"),
        F.max("pos").alias("end"),
        F.max_by("x1", "pos").alias("t1"),
        F.max_by("x2", "pos").alias("t2"),
    )
    by_key = W.partitionBy("key")
    zero = F.lit(0).cast("long")
    blocks = stage(
        last.select(
            "key",
            "conv_id",
            "block",
            "end",
            F.max("end").over(by_key).alias("n_turns"),
            *[F.coalesce(F.bit_xor(f"t{k}").over(before), zero).alias(f"b{k}") for k in (1, 2)],
            "t1",
            "t2",
        ),
        "chat-blocks",
    )
    whole = (
        blocks.filter("end = n_turns")
        .select("key", "conv_id", "n_turns", F.expr("b1 ^ t1").alias("p1"), F.expr("b2 ^ t2").alias("p2"))
        .groupBy("n_turns", "p1", "p2")
        .agg(F.min(F.struct("conv_id", "key")).alias("first"), F.count("*").alias("n_copies"))
    )
    proper = (
        rolled.select("key", "block", "pos", "x1", "x2")
        .join(blocks.select("key", "block", "n_turns", "b1", "b2"), ["key", "block"])
        .filter("pos < n_turns")
        .select(F.col("pos").alias("n_turns"), F.expr("b1 ^ x1").alias("p1"), F.expr("b2 ^ x2").alias("p2"))
        .distinct()
    )
    kept = whole.join(proper, ["n_turns", "p1", "p2"], "left_anti")
    return kept.select("first.key", "first.conv_id", "n_turns", "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, F.lit("unknown")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n")
    )


def collapse_and_render(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK_TURNS,
) -> DataFrame:
    """(id, n_turns, n_copies, part, text): the rendered parts of each maximal
    conversation; ``part`` counts its blocks from 0."""
    kept = stage(maximal(df, id_col, turn_col, role_col, text_col, block), "chat-kept")
    side = F.broadcast(kept) if fits_broadcast(kept, BROADCAST_BYTES) else kept
    turns = _turns(df, id_col, turn_col, role_col, text_col, block).drop("conv_id")
    shown = turns.join(side, "key").select(
        "key", "block", *_ORDER, "conv_id", "n_turns", "n_copies", rendered_turn(F.col("role"), F.col("text")).alias("shown")
    )
    placed = _in_blocks(shown, block)
    order = W.partitionBy("key").orderBy("block")
    parts = (
        placed.groupBy("key", "block")
        .agg(*[F.first(c).alias(c) for c in ("conv_id", "n_turns", "n_copies")])
        .withColumn("part", (F.row_number().over(order) - 1).cast("long"))
    )
    texts = placed.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("nth", "shown"))).alias("turns"))
    return texts.join(parts, ["key", "block"]).select(
        F.col("conv_id").alias(id_col),
        "n_turns",
        "n_copies",
        "part",
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("text"),
    )

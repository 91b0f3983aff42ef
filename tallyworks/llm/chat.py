"""Chat rendering of logged conversations, without those that a longer one continues.

DataFrame functions only. Logs hold a conversation again and again as it grows. Every turn gets the hash of all
turns up to it; a conversation whose last such hash is an inner one of another is a snapshot of that one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import bounded, marked, placed_in_order, same
from tallyworks.sources.workspace import written

BLOCK_TURNS = 1024  # a conversation is worked on, and rendered, in parts of so many turns
KEY = ["conv_id", "turn", "d1", "d2"]  # of a turn; the last two are hashes of role and text, together 128 bits


def digested(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (missing ones empty) and the hashes d1 and d2 of role and text."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    return rows.withColumns({f"d{i}": F.xxhash64(F.lit(i), F.length("role"), "role", "text") for i in (1, 2)})


def positions(rows: DataFrame) -> DataFrame:
    """The distinct turns of `rows` as KEY with position (from 1) and part in their conversation, and n_turns.

    Turns are ordered by number, role and text. Only hashes are shuffled for that; the texts themselves only of turns
    that share their number with another one of the conversation, since these alone are ordered by them. Parts have
    BLOCK_TURNS turns, however often one turn number, or none, occurs.
    """
    keys = written(rows.select(*KEY).distinct(), "turns")
    shared = keys.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv_id", "turn")
    shared = marked(written(shared, "shared-numbers"), "conv_id", "turn")
    texts = rows.join(bounded(shared), same(rows, shared, "conv_id", "turn"), "left_semi").distinct()
    among = placed_in_order(texts, ["conv_id", "turn", "role", "text"], ["conv_id", "turn"], "rank")
    among = marked(written(among.select(*KEY, "rank"), "ranks"), *KEY)
    ranked = keys.join(bounded(among), same(keys, among, *KEY), "left").select(*KEY, F.coalesce("rank", F.lit(0)).alias("rank"))
    placed = placed_in_order(ranked, ["conv_id", "turn", "rank"], ["conv_id"], "before")
    part = F.floor(F.col("before") / BLOCK_TURNS).cast("int")
    return placed.select(*KEY, (F.col("before") + 1).alias("position"), part.alias("part"), F.col("of_group").alias("n_turns"))


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """The turns with h1 and h2, together 128 bits for the turns up to each one.

    They are the exclusive or of the hashes of (position, role, text), first within a part, then over the
    parts before; whether turns are numbered from 0 or 1 makes no difference.
    """
    inner = Window.partitionBy("conv_id", "part").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumns({f"_h{i}": F.xxhash64(F.lit(i), "position", "d1", "d2") for i in (1, 2)})
    blocks = rows.groupBy("conv_id", "part").agg(F.bit_xor("_h1").alias("_x1"), F.bit_xor("_h2").alias("_x2"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "conv_id", "part", *(F.coalesce(F.bit_xor(f"_x{i}").over(before), zero).alias(f"_b{i}") for i in (1, 2))
    )
    blocks = marked(blocks, "conv_id", "part")
    rows = rows.withColumns({f"_r{i}": F.bit_xor(f"_h{i}").over(inner) for i in (1, 2)})
    rows = rows.join(blocks, same(rows, blocks, "conv_id", "part"))
    return rows.select(
        "conv_id", "position", "n_turns", *(F.col(f"_r{i}").bitwiseXOR(F.col(f"_b{i}")).alias(f"h{i}") for i in (1, 2))
    )


def maximal(hashes: DataFrame) -> DataFrame:
    """conv_id of each conversation that is not the beginning of a longer one; of equal ones the smallest id.

    Inner hashes are combined before the shuffle, so a first turn that most conversations share is one row a
    task there.
    """
    whole = hashes.where(F.col("position") == F.col("n_turns"))
    kept = whole.groupBy("position", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    inner = hashes.where(F.col("position") < F.col("n_turns")).select("position", "h1", "h2").distinct()
    return kept.join(inner, ["position", "h1", "h2"], "left_anti").select("conv_id")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def chats(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns and text of the maximal conversations of `turns` (conv_id, turn, role, text).

    A text has the conversation's turns in the chat format. Conversations with more than BLOCK_TURNS
    turns come in parts, from 0; n_turns is that of the whole. Repeated rows are one turn; rows with the same
    number are ordered by role and text; missing roles and texts are empty, missing numbers come first. Rows
    without conv_id are one conversation, kept only if no other begins with or equals it.
    """
    rows = digested(turns)
    placed = written(positions(rows), "placed-turns")
    kept = maximal(written(prefix_hashes(placed), "prefix-hashes")).select(F.col("conv_id").alias("conv_id_"))
    kept = bounded(written(kept, "kept"))
    chosen = placed.join(kept, same(placed, kept, "conv_id"), "left_semi")
    ids = written(chosen.select("conv_id", "n_turns").distinct(), "chosen")
    short = short_texts(rows, ids.where(F.col("n_turns") <= BLOCK_TURNS).select("conv_id"))
    return short.unionByName(long_texts(rows, written(chosen.where(F.col("n_turns") > BLOCK_TURNS), "long")))


def short_texts(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The conversations `ids` in the chat format, each of one part: their turns meet in one group and are sorted
    there, so that a text is shuffled once."""
    named = {"_id": F.coalesce("conv_id", F.lit(0)), "_none": F.col("conv_id").isNull()}
    wanted = rows.withColumns(named).join(bounded(ids.select(*(c.alias(n) for n, c in named.items()))), list(named), "left_semi")
    turns = F.array_sort(F.collect_set(F.struct("turn", "role", "text")))
    found = wanted.groupBy(*named).agg(turns.alias("_turns"))
    text = F.array_join(F.transform("_turns", lambda t: render(t["role"], t["text"])), "")
    conv_id = F.when(~F.col("_none"), F.col("_id")).alias("conv_id")
    return found.select(conv_id, F.lit(0).alias("part"), F.size("_turns").cast("long").alias("n_turns"), text.alias("text"))


def long_texts(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The turns in `placed`, of conversations with many, in the chat format part by part."""
    ids = marked(bounded(written(placed.select("conv_id").distinct(), "long-ids")), "conv_id")
    wanted, places = rows.join(ids, same(rows, ids, "conv_id"), "left_semi"), marked(placed, *KEY)
    turn = F.struct("position", render(F.col("role"), F.col("text")).alias("text"))
    parts = wanted.join(places, same(wanted, places, *KEY)).groupBy("conv_id", "part", "n_turns").agg(
        F.array_sort(F.collect_set(turn)).alias("_turns")  # a set: copies of a turn have one place
    )
    return parts.select("conv_id", "part", "n_turns", F.array_join(F.transform("_turns", lambda t: t["text"]), "").alias("text"))

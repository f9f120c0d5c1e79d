"""Chat formatting after the collapse of cumulative snapshots.

Logs often hold a conversation several times, each time with more turns. A conversation is known by two 64-bit hashes of its
turns: the exclusive or of hashes of (turn number, role, text), which grows turn by turn. A conversation whose hash is met
inside another one is a prefix of it and goes, by an anti-join; of equal conversations the smallest identifier stays.

Prefix hashes are running sums over blocks of BLOCK turns first and inside blocks then, so that no window holds more than a
block or a conversation's list of blocks, whatever a conversation's length. Equal conversations are merged before the
anti-join, so a common conversation or first turn is one row there. A rendered conversation is one value of the result and so
one row.

Defined results: rows repeated within a conversation count once; turns of one number are ordered by role and text, nulls
first; a null role is written as "unknown", a null text as empty, and both differ from those words; the marks of turns inside roles
and texts get a space, line ends in roles become spaces; rows with a null
conv_id form one conversation; an empty table gives an empty table; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.llm.common import stash

BLOCK = 256


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, n (turns so far), p1 and p2 (hashes of the turns so far), last (whether it is the last turn)."""
    row = [F.col("turn"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    rows = conversations.select("conv_id", "turn", F.xxhash64(F.lit(1), *row).alias("h1"), F.xxhash64(F.lit(2), *row).alias("h2")).distinct()
    sums = [F.count(F.lit(1)).alias("k"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")]
    turns = rows.groupBy("conv_id", "turn").agg(*sums).withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK))
    blocks = turns.groupBy("conv_id", "block").agg(F.sum("k").alias("k"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.max("turn").alias("end"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "conv_id", "block", F.coalesce(F.sum("k").over(before), zero).alias("k0"), F.coalesce(F.bit_xor("h1").over(before), zero).alias("b1"), F.coalesce(F.bit_xor("h2").over(before), zero).alias("b2"),
        (F.lead("block").over(Window.partitionBy("conv_id").orderBy("block"))).isNull().alias("tail"),
    )
    w = Window.partitionBy("conv_id", "block").orderBy("turn")
    inside = turns.select("conv_id", "block", "turn", F.sum("k").over(w).alias("k"), F.bit_xor("h1").over(w).alias("h1"), F.bit_xor("h2").over(w).alias("h2"), F.lead(F.lit(1)).over(w).isNull().alias("end"))
    on = F.col("i.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("i.block") == F.col("b.block"))
    return inside.alias("i").join(blocks.alias("b"), on).select(
        "i.conv_id", "turn", (F.col("k") + F.col("k0")).alias("n"), F.col("h1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("h2").bitwiseXOR(F.col("b2")).alias("p2"), (F.col("end") & F.col("tail")).alias("last")
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that are no proper prefix of another, one of each kind."""
    hashes = stash(prefix_hashes(conversations))
    kinds = hashes.where("last").groupBy("p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.max("n").alias("n_turns"), F.count(F.lit(1)).alias("n_copies"))
    inner = hashes.where("not last").select("p1", "p2").distinct()
    return kinds.join(inner, ["p1", "p2"], "left_anti").select("conv_id", "n_turns", "n_copies")


def plain(value: Column) -> Column:
    """A role or text without the marks of turns: a space goes into them, so that no text can pose as a turn."""
    return F.replace(value, F.lit("<|im_"), F.lit("<| im_"))


def rendered(turns: Column) -> Column:
    """An array of (turn, role, text) as one text."""
    role = lambda t: F.replace(plain(F.coalesce(t["role"], F.lit("unknown"))), F.lit("\n"), F.lit(" "))
    one = lambda t: F.concat(F.lit("<|im_start|>"), role(t), F.lit("\n"), plain(F.coalesce(t["text"], F.lit(""))), F.lit("<|im_end|>\n"))
    return F.array_join(F.transform(turns, one), "")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of each maximal conversation.

    The identifier goes into a struct, which is equal to another also where it holds a null: the join and the grouping have
    one key then, and texts are shuffled once.
    """
    key = F.struct("conv_id")
    kept = maximal(conversations).select(key.alias("k"), "n_turns", "n_copies")
    turns = conversations.select(key.alias("k"), F.struct("turn", "role", "text").alias("t")).join(kept, "k")
    grouped = turns.groupBy("k").agg(F.sort_array(F.collect_set("t")).alias("turns"), F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"))
    return grouped.select("k.conv_id", "n_turns", "n_copies", rendered(F.col("turns")).alias("text"))


#: DuckDB SQL for format_chats over the table conversations; prefixes are compared as strings of hashes here, a null's being empty.
SQL = """
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
marked AS (SELECT *, concat(turn, ':', md5('V' || role), ':', md5('V' || text)) AS m FROM rows),
turns AS (SELECT conv_id, turn, count(*) AS k, string_agg(m, ',' ORDER BY m) AS t FROM marked GROUP BY conv_id, turn),
prefixes AS (
    SELECT conv_id, md5(string_agg(t, ';') OVER w) AS p, sum(k) OVER w AS n, lead(k) OVER w IS NULL AS last
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST)
),
kinds AS (
    SELECT p, min(conv_id) AS conv_id, max(n) AS n_turns, count(*) AS n_copies FROM prefixes WHERE last GROUP BY p
),
kept AS (SELECT * FROM kinds WHERE p NOT IN (SELECT p FROM prefixes WHERE NOT last))
SELECT rows.conv_id, CAST(max(n_turns) AS BIGINT) AS n_turns, max(n_copies) AS n_copies,
    string_agg(concat('<|im_start|>', replace(replace(coalesce(role, 'unknown'), '<|im_', '<| im_'), chr(10), ' '), chr(10), replace(coalesce(text, ''), '<|im_', '<| im_'), '<|im_end|>', chr(10)),
        '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS text
FROM rows JOIN kept ON rows.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY rows.conv_id
"""

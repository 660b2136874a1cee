"""Chat formatting: snapshots of growing conversations collapse to the longest, which are rendered.

A log often holds the same conversation again after every turn. Each turn is hashed with its place, role and text; the
running combination of these hashes names every prefix. Of equal conversations the smallest conv_id stays; an anti-join
drops those whose full hash is a proper prefix hash of another; the rest are rendered with role markers.

Turns are numbered and rendered in blocks, so that one very long conversation is spread over tasks; only its rendering,
one row, comes together.

Everything is DataFrame functions. Defined results: exact repeats of a turn row count once; turns are ordered by turn,
role, text, nulls first; null role or text is not equal to empty and renders as empty; rows with a null conv_id form one
conversation; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Turn numbers to a block; a block's turns meet in one task.
BLOCK = 256


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, block, place): distinct turns with their place, from 0, in the conversation; stored."""
    c = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).distinct()
    c = c.withColumn("block", F.floor(F.col("turn") / BLOCK))
    sizes = c.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = F.row_number().over(W.partitionBy("conv_id", "block").orderBy("turn", "role", "text"))
    own = c.withColumn("inner", inner).alias("c")
    b = before.alias("b")
    out = own.join(b, F.col("c.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("c.block").eqNullSafe(F.col("b.block")))
    return stored(out.select("c.conv_id", "c.turn", "c.role", "c.text", "c.block", (F.col("before") + F.col("inner") - 1).alias("place")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, h1, h2): the 128-bit hash of the conversation up to each place."""

    def leaf(salt: int):
        # sha2 keeps different turns apart; the place makes order count, so that hashes can be combined with xor
        said = F.concat_ws("\u0001", F.lit(str(salt)), F.col("place").cast("string"), F.coalesce(F.concat(F.lit("r"), F.hex(F.col("role"))), F.lit("-")), F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("-")))
        return F.xxhash64(F.sha2(said.cast("binary"), 256), F.lit(salt))

    t = turns.select("conv_id", "block", "place", leaf(1).alias("g1"), leaf(2).alias("g2"))
    sums = t.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"))
    w = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    off = sums.select("conv_id", "block", *(F.coalesce(F.bit_xor(f"s{k}").over(w), F.lit(0)).alias(f"o{k}") for k in (1, 2))).alias("o")
    w = W.partitionBy("conv_id", "block").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    run = t.select("conv_id", "block", "place", *(F.bit_xor(f"g{k}").over(w).alias(f"r{k}") for k in (1, 2))).alias("r")
    on = F.col("r.conv_id").eqNullSafe(F.col("o.conv_id")) & F.col("r.block").eqNullSafe(F.col("o.block"))
    return run.join(off, on).select("r.conv_id", "place", *(F.col(f"r{k}").bitwiseXOR(F.col(f"o{k}")).alias(f"h{k}") for k in (1, 2)))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no proper prefix of another; of equal ones the smallest id, null first."""
    pre = stored(prefix_hashes(turns))
    ends = pre.groupBy("conv_id").agg(F.max(F.struct("place", "h1", "h2")).alias("e"))
    whole = ends.groupBy(F.col("e.place").alias("place"), F.col("e.h1").alias("h1"), F.col("e.h2").alias("h2")).agg(F.min(F.struct("conv_id")).alias("id"), F.count("*").alias("n_copies"))
    # every hash once on either side: a first turn that most conversations share is one row
    every = pre.groupBy("place", "h1", "h2").agg(F.count("*").alias("c"))
    longer = every.join(whole.select("place", "h1", "h2", "n_copies"), ["place", "h1", "h2"]).where("c > n_copies").select("place", "h1", "h2")
    return whole.join(longer, ["place", "h1", "h2"], "left_anti").select("id.conv_id", (F.col("place") + 1).cast("long").alias("n_turns"), "n_copies")


def rendered(conversations: DataFrame, opening: str = "<|im_start|>", closing: str = "<|im_end|>") -> DataFrame:
    """conv_id, n_turns, n_copies, chat: the maximal conversations as marked text."""
    turns = numbered(conversations)
    best = maximal(turns).alias("m")
    line = F.concat(F.lit(opening), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(f"{closing}\n"))
    t = turns.select("conv_id", (F.floor(F.col("place") / BLOCK)).cast("long").alias("part"), F.struct("place", line.alias("s")).alias("x")).alias("t")
    own = t.join(best, F.col("t.conv_id").eqNullSafe(F.col("m.conv_id"))).groupBy("t.conv_id", "part", "n_turns", "n_copies").agg(F.sort_array(F.collect_list("x")).alias("x"))
    parts = own.select("conv_id", "n_turns", "n_copies", F.struct("part", F.array_join("x.s", "").alias("s")).alias("x"))
    whole = parts.groupBy("conv_id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return whole.select("conv_id", "n_turns", "n_copies", F.array_join("x.s", "").alias("chat"))


ORACLE = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
    coalesce('r' || role, '-') || chr(1) || coalesce('t' || text, '-') AS s
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
p AS (SELECT conv_id, k, string_agg(s, chr(2)) OVER (PARTITION BY conv_id ORDER BY k) AS s FROM t),
e AS (SELECT conv_id, k, s FROM p QUALIFY k = max(k) OVER (PARTITION BY conv_id)),
w AS (SELECT s, k, min(conv_id) AS conv_id, count(*) AS n_copies FROM e GROUP BY 1, 2),
longer AS (SELECT DISTINCT p.s FROM p JOIN e ON p.conv_id = e.conv_id AND p.k < e.k)
SELECT w.conv_id, w.k AS n_turns, n_copies,
  string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY t.k) AS chat
FROM w JOIN t ON w.conv_id = t.conv_id WHERE w.s NOT IN (SELECT s FROM longer) GROUP BY 1, 2, 3
"""

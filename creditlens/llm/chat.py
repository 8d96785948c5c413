"""Chat formatting after collapsing cumulative snapshots.

Logs often hold a conversation many times, each time with more turns.  Rolling
turn-prefix hashes (a running sum of hashes salted by the place of the turn,
two seeds) name every prefix of every conversation; a conversation whose whole
hash is a proper prefix of another one is dropped by an anti-join, equal
conversations keep the one with the smallest id, and the rest is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlens.llm.common import store


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, k, h1, h2)``: the rolling hashes after the k-th turn.
    Only ids, places and hashes are shuffled."""
    turn = lambda seed: F.xxhash64(F.lit(seed), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    order = Window.partitionBy("conv_id").orderBy("turn", "a", "b")
    salted = (turns.select("conv_id", "turn", turn(1).alias("a"), turn(2).alias("b"))
              .withColumn("k", F.row_number().over(order)))
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    rolling = lambda c: F.sum(F.xxhash64(F.col("k"), F.col(c)).cast("decimal(28,0)")).over(run)
    return salted.select("conv_id", "k", rolling("a").alias("h1"), rolling("b").alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies)`` of the conversations that stay."""
    rolled = store(prefixes(turns), "chat-prefixes")
    last = rolled.groupBy(F.col("conv_id").alias("_id")).agg(F.max("k").alias("n"))
    marked = rolled.join(last, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")
    # both sides are reduced to distinct keys first, so a very common conversation or first turn is one row
    whole = (marked.where("k = n").groupBy("k", "h1", "h2")
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    proper = marked.where("k < n").select("k", "h1", "h2").distinct()
    return whole.join(proper, ["k", "h1", "h2"], "left_anti").select("conv_id", F.col("k").alias("n_turns"), "n_copies")


def render(turns: DataFrame, start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """``(conv_id, text)``: the turns of a conversation in order."""
    line = F.concat(F.lit(start), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(end + "\n"))
    key = lambda seed: F.xxhash64(F.lit(seed), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    rows = turns.select("conv_id", F.struct("turn", key(1).alias("a"), key(2).alias("b"), line.alias("line")).alias("t"))
    return rows.groupBy("conv_id").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list("t")), lambda t: t["line"])).alias("text"))


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies, text)`` of the maximal conversations.

    Turns are ordered by ``turn`` (nulls first), rows of equal place by a hash
    of role and text; repeated rows are turns of their own.  Null roles and
    texts read as ''.  Rows without a conv_id form one conversation with a
    null id.  Other columns are ignored; an empty table gives an empty result.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    stay = maximal(turns)
    kept = turns.join(stay.select(F.col("conv_id").alias("_id")), turns["conv_id"].eqNullSafe(F.col("_id")), "left_semi")
    text = render(kept)
    return (stay.join(text.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")))
            .select("conv_id", F.col("n_turns").cast("long"), "n_copies", "text"))

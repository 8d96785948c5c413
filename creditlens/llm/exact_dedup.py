"""Exact duplicates by skew-safe combining.

Texts are combined three times, and every time rows only meet when digest
*and* whole text are equal:

1. locally: the map side of the salted aggregate keeps one row per distinct
   text of an input partition;
2. by salted digest group: ``(digest, salt, text)``.  Digests with few rows
   have salt 0 and are finished here; the rows of a frequent digest are salted
   by their input partition, so no task receives all of them;
3. globally: only the salt winners of frequent digests, by ``(digest, text)``.

So a text crosses the network once, and a frequent one a bounded number of
times more.  Which digests are frequent is counted on digests alone; at most
``MAX_HOT`` of them can pass the limit, which bounds the broadcast table.
Rows then join their group by digest.  Should two texts share a digest, the
groups of that digest are told apart, and joined, by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import store

#: Parts into which the rows of a frequent digest are dealt.
SALTS = 64
#: A digest is frequent with more than this many rows, and more than 1 / MAX_HOT of all rows.
HOT_ROWS = 1024
#: At most this many digests are frequent (the size of the broadcast table).
MAX_HOT = 10_000


def sha256(text: Column) -> Column:
    """Digest of a text (UTF-8) as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", digest(F.col("text")))


def _salted(rows: DataFrame, hot: DataFrame, by: Column) -> DataFrame:
    """``salt``: 0 for rare digests, 1 to SALTS by ``by`` for frequent ones."""
    return (rows.join(F.broadcast(hot), "digest", "left")
            .withColumn("salt", F.when(F.col("hot"), 1 + F.pmod(by, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop("hot"))


def combine(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``(digest, keep_id, n)``, one row per distinct text of
    ``(doc_id, text, digest)`` rows; ``hot`` holds the frequent digests."""
    best = lambda d: d.agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    salted = best(_salted(rows, hot, F.spark_partition_id())
                  .select("digest", "salt", "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
                  .groupBy("digest", "salt", "text"))
    # the text of a finished group is not needed any more
    salted = store(salted.withColumn("text", F.when(F.col("salt") > 0, F.col("text"))), "exact-salted")
    winners = best(salted.where("salt > 0").groupBy("digest", "text"))
    return (salted.where("salt = 0").select("digest", "keep_id", "n")
            .unionByName(winners.select("digest", "keep_id", "n")))


def find_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    digest: Callable[[Column], Column] = sha256, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(doc_id, digest, keep_id, group_size, kept)`` per input row.

    Texts are equal when identical; a null text counts as ''.  Of equal texts
    the row with the largest doc_id stays (a null id only where there is no
    other); of rows that are equal in id and text, exactly one is ``kept``.
    Very long texts are compared whole.  Other columns are ignored, an empty
    table gives an empty result.  ``digest`` may be any hash of the text:
    equal digests are never taken for equal texts.
    """
    rows = _rows(docs, id_col, text_col, digest)
    light = store(rows.select("doc_id", "digest").withColumn("row", F.monotonically_increasing_id()), "exact-rows")
    tops = store(light.groupBy("digest").agg(F.count("*").alias("rows"), F.max(F.struct("doc_id", "row")).alias("top")),
                 "exact-tops")
    total = tops.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = (tops.where(F.col("rows") > max(hot_rows, total // MAX_HOT)).select("digest", F.lit(True).alias("hot")))
    groups = (combine(rows, hot).select("digest", "keep_id", "n", F.lit(None).cast("long").alias("row"))
              .unionByName(tops.select("digest", F.lit(None).cast(tops.schema["top"].dataType["doc_id"].dataType).alias("keep_id"),
                                       F.lit(0).cast("long").alias("n"), F.col("top.row").alias("row")))
              .groupBy("digest").agg(F.count(F.when(F.col("n") > 0, 1)).alias("texts"), F.max("keep_id").alias("keep_id"),
                                     F.sum("n").alias("group_size"), F.max("row").alias("keep_row")))
    groups = store(groups, "exact-groups")
    # a frequent group is copied under each of its salts, so that its rows are dealt over them
    copies = F.explode(F.when(F.col("hot"), F.sequence(F.lit(1), F.lit(SALTS))).otherwise(F.array(F.lit(0))))
    sides = groups.where("texts = 1").join(F.broadcast(hot), "digest", "left").withColumn("salt", copies).drop("hot", "texts")
    out = (_salted(light, hot, F.col("row")).join(sides, ["digest", "salt"])
           .select("doc_id", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")))
    shared = groups.where("texts > 1").select("digest")
    return out if shared.isEmpty() else out.unionByName(_by_text(rows, shared, hot))


def _by_text(rows: DataFrame, shared: DataFrame, hot: DataFrame) -> DataFrame:
    """The result rows of digests that several texts share, joined by text."""
    part = store(rows.join(shared, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id()), "exact-shared")
    salted = _salted(part, hot, F.col("row"))
    one = (salted.groupBy("digest", "salt", "text").agg(F.max(F.struct("doc_id", "row")).alias("top"), F.count("*").alias("n"))
           .groupBy("digest", "text").agg(F.max("top").alias("top"), F.sum("n").alias("group_size")))
    one = store(one, "exact-shared-groups")
    copies = F.explode(F.when(F.col("hot"), F.sequence(F.lit(1), F.lit(SALTS))).otherwise(F.array(F.lit(0))))
    sides = one.join(F.broadcast(hot), "digest", "left").withColumn("salt", copies).drop("hot")
    return (salted.join(sides, ["digest", "salt", "text"])
            .select("doc_id", "digest", F.col("top.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("top.row")).alias("kept")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (same columns) that stay: one per distinct text,
    with the largest id.  Of rows that are equal in id and text any one stays;
    other columns play no part in the choice."""
    kept = (find_duplicates(docs, id_col, text_col).where("kept")
            .select(F.col("doc_id").alias("_keep_id"), F.col("digest").alias("_keep_digest")))
    free = lambda name: name if name not in docs.columns else free(name + "_")
    text = free("_text")
    rows = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    same = rows[id_col].eqNullSafe(kept["_keep_id"]) & (sha256(rows[text]) == kept["_keep_digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates([id_col, text]).drop(text)

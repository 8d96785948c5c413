"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.session import checkpoint_dir


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edge table behind a reliable checkpoint, and its signature."""
    edges = edges.checkpoint(eager=True)
    sig = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return edges, tuple(sig)


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of longs -> ``(node, root)``, root the smallest node.

    Each star step is a per-node minimum (combined before the shuffle) joined
    back to the edges.  That join meets all edges of a node in one task (two
    longs an edge, read as a stream); the aggregate before it keeps the skew
    join away, so a node with very many edges is not split.  Self-loops and repeated edges are allowed; nulls are not.  An empty
    table gives an empty one.
    """
    checkpoint_dir(edges.sparkSession)
    edges = (edges.where("a != b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges, sig = _checked(edges)
    while sig[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct("b", F.col("m").alias("m")),
                                           F.struct(F.col("a").alias("b"), F.col("m").alias("m")))).alias("e"))
                 .select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a != b").distinct())
        before, (edges, sig) = sig, _checked(small)
        if sig == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))

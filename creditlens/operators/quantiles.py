"""Exact quantiles without gathering a group into one task.

Spark's exact ``percentile`` merges a value -> count map of the whole group
in one task; for a group holding a third of 100 TB that does not fit.  Here
the exact answer (same linear interpolation as ``percentile``: position =
(n - 1) p, value = (higher - position) v[lower] + (position - lower)
v[higher]) is found in three distributed passes:

1. per group: row count and approximate quantiles at p -/+ a margin
   (``percentile_approx``, bounded memory); together they bracket the
   exact lower / higher order statistics in a narrow value band;
2. one aggregate, combined before its shuffle, counts per group and quantile
   the rows below the band and the distinct values inside it;
3. only the band (a fraction of about 2 x margin of the group) is ranked.

The band is widened until it holds its order statistics, at the widest the
whole group.  One algorithm serves every size; NULL is a group like any other.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.operators.sampling import join_groups

ACCURACY = 100_000


def exact_quantiles(df: DataFrame, col: str, ps: Sequence[float], group_cols: Sequence[str] = (),
                    names: Sequence[str] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``group_cols`` + one column per quantile.  NULL and
    NaN values are left out; a group without values has no row."""
    names = list(names or [f"q{i}" for i in range(len(ps))])
    groups = list(group_cols) or ["_k"]
    d = df.select(*(group_cols or [F.lit(0).alias("_k")]), F.col(col).cast("double").alias("v"))
    d = d.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    margin = 4.0 / accuracy
    while True:
        out = _banded(d, groups, [float(p) for p in ps], margin, accuracy).checkpoint(eager=True)
        if margin >= 1 or not out.filter("not _ok").limit(1).count():
            break
        margin *= 8
    res = out.select(*groups, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    return res if group_cols else res.drop("_k")


def _banded(d: DataFrame, groups: list, ps: list, margin: float, accuracy: int) -> DataFrame:
    """Groups, ``_q`` (the quantiles) and ``_ok`` (every band held its order statistics)."""
    k = len(ps)
    probes = [max(0.0, p - margin) for p in ps] + [min(1.0, p + margin) for p in ps]
    edges = d.groupBy(*groups).agg(F.count("*").alias("_n"), F.percentile_approx("v", probes, accuracy).alias("_e"))
    low = lambda i: F.col("_e")[i] if margin < 1 else F.lit(float("-inf"))
    high = lambda i: F.col("_e")[k + i] if margin < 1 else F.lit(float("inf"))
    # one pass gives, per quantile, the rows below its band (one row, no value) and the band's values with counts
    places = F.filter(F.array(*[F.when(F.col("v") <= high(i), F.struct(
        F.lit(i).alias("i"), F.when(F.col("v") >= low(i), F.col("v")).alias("v"))) for i in range(k)]),
        lambda x: x.isNotNull())
    cells = (join_groups(d, edges, groups).select(*groups, "_n", F.explode(places).alias("x"))
             .groupBy(*groups, "_n", F.col("x.i").alias("i"), F.col("x.v").alias("v")).agg(F.count("*").alias("c")))
    upto = F.sum("c").over(Window.partitionBy(*groups, "i").orderBy(F.col("v").asc_nulls_first()))
    at = (F.col("_n") - 1).cast("double") * F.element_at(F.array(*[F.lit(p) for p in ps]), F.col("i") + 1)
    ranked = cells.withColumn("_at", at).withColumn("_upto", upto).where("v is not null")
    holds = lambda place: (F.col("_upto") - F.col("c") <= place) & (place < F.col("_upto"))
    found = ranked.groupBy(*groups, "i", "_at").agg(
        F.max(F.when(holds(F.floor("_at")), F.col("v"))).alias("a"), F.max(F.when(holds(F.ceil("_at")), F.col("v"))).alias("b"))
    quantiles = found.groupBy(*groups).agg(
        F.array_sort(F.collect_list(F.struct("i", _between("a", "b", "_at").alias("q")))).alias("_q"),
        F.bool_and(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("_held"))
    return (join_groups(edges.select(*groups), quantiles, groups, "left")
            .select(*groups, F.transform("_q", lambda x: x["q"]).alias("_q"),
                    (F.coalesce("_held", F.lit(False)) & (F.size("_q") == k)).alias("_ok")))


def _between(low: str, high: str, at: str) -> Column:
    """Linear interpolation between neighbouring order statistics, as ``percentile`` has it."""
    a, b, place = F.col(low), F.col(high), F.col(at)
    return F.when((F.floor(place) == F.ceil(place)) | (a == b), a).otherwise(
        (F.ceil(place).cast("double") - place) * a + (place - F.floor(place).cast("double")) * b)


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict:
    """Median of each column (one unpivoted pass for all columns)."""
    if not cols:
        return {}
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "_col", "_v")
    q = exact_quantiles(long, "_v", [0.5], ["_col"], ["m"])
    got = {r["_col"]: r["m"] for r in q.collect()}
    return {c: got.get(c) for c in cols}

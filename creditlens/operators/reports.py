"""Report operators: profiles, descriptive statistics, frequency tables,
correlations, tiers, histograms and box plots.

All of them are single aggregate passes (or two for the two-pass box plot)
with partial aggregation; "share of total" uses a scalar subquery, never an
unpartitioned window.  Exact quantiles come from ``operators.quantiles`` (same linear
interpolation as Spark's ``percentile`` and pandas, computed without
gathering a group into one task).
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from creditlens.operators.quantiles import exact_quantiles
from creditlens.operators.sampling import join_groups


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1000000.0 + 0.5) / 1000000.0


def exact_sum(c) -> Column:
    """Order-independent sum of a DOUBLE column (DECIMAL(38,9) accumulation,
    DOUBLE result), so totals do not depend on partitioning."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(38,9)")).cast("double")


def _long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` (cast to DOUBLE) into (ids..., column_name, value)."""
    base = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return base.unpivot(list(ids), list(cols), "column_name", "value")


def null_counts(df: DataFrame) -> DataFrame:
    """AGG-23: one aggregate row of null counts, unpivoted."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "column_name", "null_count")


def write_profiled(df: DataFrame, root: str) -> dict:
    """AGG-23 without a scan of its own: write ``df`` as the new version of the
    table at ``root`` and return ``rows`` and the ``nulls`` of each column,
    observed while the rows are written.  The manifest holds them too."""
    from creditlens.sources.versions import publish
    seen = Observation(f"profile-{uuid.uuid4().hex}")
    names = {f"c{i}": c for i, c in enumerate(df.columns)}
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(k) for k, c in names.items()])
    counts: dict = {}

    def write(folder: str) -> None:
        watched.write.parquet(folder)
        got = seen.get
        counts.update(rows=got["rows"], nulls={c: got[k] for k, c in names.items()})

    publish(df.sparkSession, root, write, counts)
    return counts


def column_profile(df: DataFrame) -> DataFrame:
    """AGG-24: rows, nulls and distinct count per column.  Distinct counts
    use one aggregate per column over (column_name, value) pairs cast to
    string, so every column shares a single shuffle."""
    cols = df.columns
    n = df.select(F.count("*")).scalar()
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(c).cast("string").alias("v")) for c in cols])).alias("p"))
    prof = (long.groupBy(F.col("p.column_name").alias("column_name"))
            .agg(F.count_if(F.col("p.v").isNull()).alias("n_null"),
                 F.count_distinct("p.v").alias("n_distinct")))
    return prof.select("column_name", n.alias("n_rows"), "n_null", "n_distinct")


def quantile_table(df: DataFrame, c: str, ps, group_cols=(), names=None) -> DataFrame:
    """One row per group with the requested quantiles of ``c``."""
    names = list(names or [f"q{i}" for i in range(len(ps))])
    return exact_quantiles(df, c, ps, group_cols, names)


def describe(df: DataFrame, cols: Sequence[str], group: str | None = None) -> DataFrame:
    """AGG-14: count, mean, sample std, min, quartiles, max per column (and
    group), from one unpivot, one aggregate and the exact quartile passes."""
    ids = [group] if group else []
    long = _long(df, cols, ids)
    stats = (long.groupBy(*ids, "column_name")
             .agg(F.count("value").alias("count"), r6(F.avg("value")).alias("mean"),
                  r6(F.stddev_samp("value")).alias("std"), F.min("value").alias("min"), F.max("value").alias("max")))
    q = quantile_table(long, "value", [0.25, 0.5, 0.75], ids + ["column_name"], ["_p25", "_p50", "_p75"])
    out = join_groups(stats, q, ids + ["column_name"], "left")
    return out.select(*ids, "column_name", "count", "mean", "std", "min",
                      r6(F.col("_p25")).alias("p25"), r6(F.col("_p50")).alias("p50"),
                      r6(F.col("_p75")).alias("p75"), "max")


def top_k_frequent(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """SRT-02: the k most frequent values per group (ties by value).  The
    ``row_number() <= k`` filter becomes a WindowGroupLimit, so each task
    keeps only its top k per group before the shuffle."""
    f = df.groupBy(group, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), F.col(value))
    return f.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def corr_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """AGG-22: Pearson correlation of each column with ``target`` (NULL for a
    constant column), one aggregate row unpivoted."""
    t0 = F.col(target).cast("double")
    aggs = []
    for c in cols:
        x0 = F.col(c).cast("double")
        both = x0.isNotNull() & t0.isNotNull()
        x, t = F.when(both, x0), F.when(both, t0)   # pairwise-complete rows
        den = F.stddev_pop(x) * F.stddev_pop(t)
        aggs.append(F.when(den > 0, r6(F.try_divide(F.covar_pop(x, t), den))).alias(c))
    return df.agg(*aggs).unpivot([], list(cols), "column_name", "corr")


def value_tiers(df: DataFrame, value: str, measure: str) -> DataFrame:
    """AGG-31: terciles (right-closed, lowest included, as ``qcut``), then
    mean of ``measure``, count and share per tier."""
    import math
    e = quantile_table(df, value, [1.0 / 3, 2.0 / 3], names=["e1", "e2"]).first()
    e1 = math.floor(e["e1"] * 1000000.0 + 0.5) / 1000000.0 if e and e["e1"] is not None else None
    e2 = math.floor(e["e2"] * 1000000.0 + 0.5) / 1000000.0 if e and e["e2"] is not None else None
    n = df.select(F.count("*")).scalar()
    v = r6(F.col(value))
    tier = F.when(v <= F.lit(e1), "Low").when(v <= F.lit(e2), "Medium").otherwise("High")
    return (df.withColumn("value_tier", tier).groupBy("value_tier")
            .agg(r6(F.avg(measure)).alias("avg_cli"), F.count("*").alias("n_users"))
            .withColumn("pct_users", r6(F.col("n_users") * 100.0 / n)))


def business_impact(scored: DataFrame, utilisation=0.25, interest=0.18, default_share=0.3) -> DataFrame:
    """AGG-30 over eligible users (segments 0 and 1)."""
    e = scored.filter(F.col("segment_label").isin(0, 1))
    total = scored.select(F.count("*")).scalar()
    a = e.agg(exact_sum("recommended_cli_amount").alias("tc"), F.avg("recommended_cli_amount").alias("ac"),
              F.count("*").alias("eligible_accounts"), F.avg("risk_probability").alias("ar"))
    rate = F.col("ar") * default_share
    return a.select(r6(F.col("tc")).alias("total_cli"), r6(F.col("ac")).alias("avg_cli"), "eligible_accounts",
                    total.alias("total_accounts"),
                    r6(F.col("tc") * utilisation * interest).alias("est_revenue"),
                    r6(rate).alias("est_default_rate"),
                    r6(F.col("tc") * utilisation * rate).alias("est_default_loss"),
                    r6(F.col("tc") * utilisation * interest - F.col("tc") * utilisation * rate).alias("net_impact"))


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """AGG-28: equal-width bins over [min, max] (max falls in the last bin)."""
    mn = df.select(F.min(c)).scalar()
    mx = df.select(F.max(c)).scalar()
    b = F.least(F.floor((F.col(c) - mn) / (mx - mn) * bins), F.lit(bins - 1)).cast("long")
    return (df.select(b.alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
            .select("bin", "n", r6(mn + (mx - mn) * F.col("bin") / bins).alias("bin_lo"),
                    r6(mn + (mx - mn) * (F.col("bin") + 1) / bins).alias("bin_hi")))


def boxplot(df: DataFrame, group: str, c: str) -> DataFrame:
    """AGG-29: quartiles per group (pass 1), whiskers = extreme values inside
    1.5 IQR and outlier count (pass 2, join on the small per-group table)."""
    q = quantile_table(df, c, [0.25, 0.5, 0.75], [group], ["q1", "med", "q3"]).checkpoint(eager=True)
    j = join_groups(df.select(group, c), q, [group])
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(c)
    return (j.groupBy(group, "q1", "med", "q3")
            .agg(r6(F.min(F.when(x >= lo, x))).alias("whisker_low"),
                 r6(F.max(F.when(x <= hi, x))).alias("whisker_high"),
                 F.count_if((x < lo) | (x > hi)).alias("n_outliers"))
            .select(group, r6(F.col("q1")).alias("q1"), r6(F.col("med")).alias("median"),
                    r6(F.col("q3")).alias("q3"), "whisker_low", "whisker_high", "n_outliers"))

"""Model evaluation metrics as aggregates (ML-12..16).

Everything reduces to one aggregate pass or to a small table of counts
(classes x classes, or distinct scores), so evaluation never gathers the
scored rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """ML-12 on the pairwise-complete rows (FLT-10): n, MSE, RMSE, R^2
    (1 - SSE/SST, not squared correlation), MAPE with max(actual, 1), RMSE as
    % of the mean.  R^2 is NULL where the actual values are all equal, the share
    of the mean where that is 0."""
    d = df.select(F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p")).dropna()
    err = F.col("y") - F.col("p")
    a = d.agg(F.count("*").alias("n"), F.avg(err * err).alias("mse"), F.var_pop("y").alias("vy"),
              F.avg(F.abs(err / F.greatest(F.col("y"), F.lit(1.0)))).alias("ape"), F.avg("y").alias("my"))
    return a.select("n", "mse", F.sqrt("mse").alias("rmse"), (F.lit(1.0) - F.try_divide("mse", "vy")).alias("r2"),
                    (F.col("ape") * 100).alias("mape"), (F.try_divide(F.sqrt("mse"), F.col("my")) * 100).alias("rmse_pct_of_mean"))


def pair_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """ML-13 + ML-15: precision / recall / F1 / support per class (0 when a
    denominator is 0) and overall accuracy, from the (actual, predicted)
    count table."""
    c = pair_counts(df, y, p)
    tp = c.filter(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("cls"), F.col("n").alias("tp"))
    sup = c.groupBy(F.col("actual").alias("cls")).agg(F.sum("n").alias("support"))
    pred = c.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("n_pred"))
    acc = c.select((F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
                    / F.sum("n")).alias("a")).scalar()
    j = sup.join(pred, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "n_pred"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    out = j.select("cls", prec.alias("precision"), rec.alias("recall"), F.col("support").cast("long").alias("support"))
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return out.select("cls", "precision", "recall", f1.alias("f1"), "support", acc.alias("accuracy"))


def confusion_matrix(df: DataFrame, y: str, p: str, classes: Sequence[int]) -> DataFrame:
    """ML-14: counts completed over the classes x classes grid (zeros)."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], "actual int, predicted int")
    c = pair_counts(df, y, p)
    return grid.join(c, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def roc_auc(df: DataFrame, y: str, score: str, buckets: int = 512) -> DataFrame:
    """ML-16: exact ROC AUC by the rank-sum identity
    AUC = sum_pos (negatives below + half the tied negatives) / (P * N).

    Rows are first reduced to (distinct score -> pos, neg) counts (partial
    aggregation absorbs hot scores).  The running count of negatives is
    computed in two levels — per bucket between quantiles of the distinct
    scores (small table, cumulative window) and within a bucket (window
    partitioned by bucket) — so every window holds its share of the scores,
    however they are spread.  NULL when only one class is present."""
    s = df.select(F.col(score).cast("double").alias("s"), F.col(y).cast("int").alias("y")).dropna()
    per = s.groupBy("s").agg(F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("pos"),
                             F.sum(F.when(F.col("y") == 1, 0).otherwise(1)).alias("neg"))
    edges = per.agg(F.percentile_approx("s", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0]
    at = F.array(*[F.lit(e) for e in sorted(set(edges or []))]).cast("array<double>")
    per = per.withColumn("b", F.size(F.filter(at, lambda e: e < F.col("s"))).cast("long"))
    bt = per.groupBy("b").agg(F.sum("neg").alias("bneg"))
    wb = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # <= `buckets` rows
    bt = bt.withColumn("neg_before_bucket", F.coalesce(F.sum("bneg").over(wb), F.lit(0))).drop("bneg")
    per = per.join(bt, "b")
    wi = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("neg_below", F.col("neg_before_bucket") + F.coalesce(F.sum("neg").over(wi), F.lit(0)))
    a = per.agg(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)).alias("u"),
                F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / (F.col("P") * F.col("N")))
                    .alias("auc"), F.col("P").alias("n_pos"), F.col("N").alias("n_neg"))

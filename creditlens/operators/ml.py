"""Spark ML side: feature preparation and the gradient-boosted models."""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def standardise(df: DataFrame, cols: Sequence[str], fit_filter: Column | None = None) -> DataFrame:
    """ML-04: (x - mean) / population std, statistics fitted on the rows of
    ``fit_filter`` (training rows) and applied to all rows; zero std -> 1.
    Spark ML's StandardScaler divides by the sample std, so the scaling is
    written as expressions; the 2 x k statistics come back as one row."""
    fit = df if fit_filter is None else df.filter(fit_filter)
    row = fit.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                  *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m_{i}"], row[f"s_{i}"]
        s = 1.0 if (s is None or s == 0) else float(s)
        out[c] = (F.col(c) - F.lit(float(m) if m is not None else 0.0)) / F.lit(s)
    return df.withColumns(out)


ROWS_PER_PARTITION = 250_000


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of a prepared feature table (reliable checkpoint in
    the session's checkpoint folder) and keep it cached for the booster.
    The booster runs one job per tree level, so the table is laid out in
    partitions of about ``ROWS_PER_PARTITION`` rows (sized from its count),
    with at least the default parallelism."""
    cp = df.checkpoint(eager=True)
    n = cp.count()
    # never below the cluster's default parallelism (each tree-level job
    # should still use every core), never above one partition per ~250 k rows
    parts = max(cp.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_PARTITION))
    if parts < cp.rdd.getNumPartitions():
        cp = cp.coalesce(parts)
    return cp.persist(StorageLevel.MEMORY_AND_DISK)


# ---------------------------------------------------------------- models
#
# The models use the regularised second-order booster of ``boosting``.  Splits
# are hash-determined (stable under repartitioning); in the early-stopped
# models (all but the increase amount) every round is scored on a validation
# subset of the training rows, never on the test rows, and the fit ends when
# ``patience`` rounds brought no better one.

from dataclasses import dataclass, field  # noqa: E402


from pyspark.ml import PipelineModel  # noqa: E402

from creditlens.functions import rules as R  # noqa: E402
from creditlens.operators import boosting as B  # noqa: E402
from creditlens.operators import metrics as M  # noqa: E402
from creditlens.operators import sampling as S  # noqa: E402
from creditlens.operators.prepare import impute_model_features  # noqa: E402
from creditlens.operators.scoring import add_macro  # noqa: E402
from creditlens.sources.versions import current, publish, read_version, write_version  # noqa: E402

# Model feature lists
Q4_FEATURES = ["avg_monthly_spend_2024", "total_spend_2024", "spend_2024_q1", "spend_2024_q2", "spend_2024_q3",
               "utilization_pct", "credit_score", "credit_line", "payment_hist_1_12_delinquency_count",
               "current_balance", "is_high_income", "q4_adjustment_factor"]
Q3_FEATURES = ["spend_2024_q1", "spend_2024_q2", "transactions_2024_q1", "transactions_2024_q2", "utilization_pct",
               "credit_score", "credit_line", "num_accounts", "payment_hist_1_12_delinquency_count",
               "payment_hist_13_24_delinquency_count", "current_balance", "is_high_income"]
SEGMENT_FEATURES = ["credit_score", "delinquency_12mo", "delinquency_24mo", "has_fraud", "utilization_pct",
                    "total_spend_2024", "total_spend_2025YTD", "num_accounts", "avg_transaction_size_2024",
                    "payment_hist_1_12_delinquency_count", "payment_hist_13_24_delinquency_count",
                    "avg_monthly_spend_2024", "credit_line", "current_balance", "is_high_income"]
RISK_FEATURES = ["credit_score", "delinquency_12mo", "delinquency_24mo", "has_fraud", "utilization_pct",
                 "total_spend_2024", "total_spend_2025YTD", "num_accounts", "active_account_count",
                 "account_age_days", "payment_hist_1_12_max_delinquency", "payment_hist_13_24_max_delinquency",
                 "avg_monthly_spend_2024", "credit_line", "current_balance", "is_high_income"]
CLI_MODEL_FEATURES = ["predicted_q4_spend", "utilization_pct", "credit_score", "credit_line", "num_accounts",
                      "avg_monthly_spend_2024", "total_spend_2024", "current_balance", "is_high_income",
                      "risk_probability", "spend_2024_q1", "spend_2024_q2", "spend_2024_q3", "spend_2024_q4",
                      "holiday_spending_multiplier", "q4_adjustment_factor"]


@dataclass
class ModelResult:
    name: str
    scored: DataFrame                      # key + prediction columns
    model: B.Boosted | list | None
    metrics: list = field(default_factory=list)   # (section, name, key, value)


def _present(df: DataFrame, cols) -> list:
    return [c for c in cols if c in df.columns]


def median_fill(df: DataFrame, cols) -> DataFrame:
    """Model-1 imputation: coerce, inf -> missing, median for every column."""
    df = df.withColumns({c: R.inf_to_null(F.expr(f"try_cast(`{c}` as double)")) for c in cols})
    from creditlens.operators.quantiles import exact_medians
    med = exact_medians(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float(med[c]) if med[c] is not None else 0.0))
                           for c in cols})


def _importances(model, cols, section: str, top: int = 10) -> list:
    """ML-17 + SRT-06: normalised importances of the fitted trees, top k."""
    pairs = sorted(model.importances().items(), key=lambda x: (-x[1], x[0]))[:top]
    return [(section, "feature_importance", c, float(v)) for c, v in pairs]


def _reg_metrics(df: DataFrame, y: str, p: str, section: str, scope: str) -> list:
    row = M.regression_metrics(df, y, p).first().asDict()
    return [(section, f"{scope}_{k}", "", float(v) if v is not None else None) for k, v in row.items()]


def stopping_round(losses: Sequence[float], patience: int) -> tuple[int, int]:
    """(best round, last round run), both counted from 1: rounds go on until
    ``patience`` of them brought no lower loss than the best before."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, i + 1
    return best + 1, len(losses)


def fit_boosted(rows: DataFrame, key: str, features, section: str, params: B.Params) -> tuple[B.Boosted, list]:
    """Fit on the rows that are not ``is_val``; the others decide when to stop.
    Without validation rows every round is kept."""
    model = B.fit(rows, [key], features, params)
    last = len(model.losses) or model.getNumTrees
    facts = {"trees": model.getNumTrees, "best_round": model.best_round, "last_round": last, "max_rounds": params.rounds,
             "patience": params.patience}
    return model, [(section, name, "", float(v)) for name, v in facts.items()]


def q4_forecast(users: DataFrame, key: str = "user_id") -> ModelResult:
    """ML-05 + ML-10 + ML-11: Q4 spend regressor (100 trees, depth 5,
    lr 0.05, row / column sampling 0.8, L1 0.1, L2 1) and the 20 % adjustment."""
    d, cols = q4_matrix(users, key)
    return _q4_fit(d, cols, key)


def q4_adjusted(prediction, factor) -> Column:
    """ML-10: a fifth of the seasonal factor is applied to a forecast."""
    return prediction * (F.lit(0.8) + F.lit(0.2) * factor)


def q4_matrix(users: DataFrame, key: str = "user_id") -> tuple[DataFrame, list]:
    """ML-01: the feature matrix of the forecast (missing values filled with
    medians), its label, and the feature names."""
    df = add_macro(users)
    feats = _present(df, Q4_FEATURES)
    y = F.col("spend_2024_q4") if "spend_2024_q4" in df.columns else F.col("total_spend_2024") * 0.35
    need = list(dict.fromkeys(feats + _present(df, ["spend_2024_q1", "spend_2024_q2", "spend_2024_q3",
                                                      "is_high_income", "credit_line", "q4_adjustment_factor"])))
    d = df.select(key, *need, R.clip(y.cast("double"), 0.01).alias("label"))
    d = d.withColumns({"q2_to_q3_growth": R.growth_clipped("spend_2024_q2", "spend_2024_q3"),
                       "high_income_credit_capacity": F.col("is_high_income") * F.col("credit_line")})
    cols = feats + ["q2_to_q3_growth", "high_income_credit_capacity"]
    return median_fill(d, cols), cols


def _q4_fit(d: DataFrame, cols: list, key: str) -> ModelResult:
    d = materialise(S.hash_split(d, [key], 0.2, 42, "is_test").withColumn(
        "is_val", (S.hash_fraction([key], 43) < 0.2) & (F.col("is_test") == 0)))
    sec = "model1_q4_spend"
    model, metrics = fit_boosted(d.filter("is_test = 0"), key, cols, sec, B.Params(
        rounds=100, depth=5, step=0.05, rows=0.8, columns=0.8, l1=0.1, l2=1.0, patience=20))
    pred = model.transform(d).checkpoint(eager=True)
    metrics += _reg_metrics(pred.filter("is_test = 1"), "label", "prediction", sec, "test")
    metrics += _importances(model, cols, sec)
    scored = pred.select(key, "is_test", F.col("prediction").alias("raw_q4_prediction"),
                         q4_adjusted(F.col("prediction"), F.col("q4_adjustment_factor")).alias("predicted_q4_spend"))
    d.unpersist()
    return ModelResult("q4_forecast", scored, model, metrics)


def q3_backtest(users: DataFrame, key: str = "user_id") -> ModelResult:
    """ML-06: predict Q3 from Q1 + Q2 (depth 5, lr 0.1, sampling 0.9),
    held-out and full-data MSE / RMSE / R^2 / MAPE."""
    feats = _present(users, Q3_FEATURES)
    d = users.select(key, *feats, F.col("spend_2024_q3").cast("double").alias("label"))
    d = d.withColumns({"avg_transaction_q1": R.guarded_avg("spend_2024_q1", "transactions_2024_q1"),
                       "avg_transaction_q2": R.guarded_avg("spend_2024_q2", "transactions_2024_q2"),
                       "q1_to_q2_growth": R.growth("spend_2024_q1", "spend_2024_q2")})
    cols = feats + ["avg_transaction_q1", "avg_transaction_q2", "q1_to_q2_growth"]
    d = median_fill(d, cols)
    d = materialise(S.hash_split(d, [key], 0.2, 42, "is_test").withColumn(
        "is_val", (S.hash_fraction([key], 44) < 0.2) & (F.col("is_test") == 0)))
    sec = "model1_q3_backtest"
    model, metrics = fit_boosted(d.filter("is_test = 0"), key, cols, sec, B.Params(
        rounds=100, depth=5, step=0.1, rows=0.9, columns=0.9, patience=10))
    pred = model.transform(d).checkpoint(eager=True)
    metrics += _reg_metrics(pred.filter("is_test = 1"), "label", "prediction", sec, "test")
    metrics += _reg_metrics(pred, "label", "prediction", sec, "full")
    metrics += _importances(model, cols, sec)
    scored = pred.select(key, "is_test", F.col("prediction").alias("predicted_q3_spend"))
    d.unpersist()
    return ModelResult("q3_backtest", scored, model, metrics)


def _classifier_frame(users: DataFrame, feats, label: str, key: str) -> DataFrame:
    d = users.select(key, *feats, F.col(label).cast("int").alias("label"))
    d = impute_model_features(d, feats)
    d = S.stratified_three_way(d, "label", [key], 0.2, 0.1, 42, "is_test", "is_val")
    return materialise(standardise(d, feats, fit_filter=F.col("is_test") == 0))


def _class_shares(df: DataFrame, section: str) -> list:
    """ML-18 class distribution (a table of at most #classes rows)."""
    rows = df.groupBy("label").agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in rows) or 1
    return [(section, "class_share", str(r["label"]), r["n"] / total) for r in sorted(rows, key=lambda r: r["label"])]


def _cls_metrics(pred: DataFrame, section: str) -> list:
    rep = M.classification_report(pred, "label", "predicted").collect()
    out = []
    for r in rep:
        out += [(section, "precision", str(r["cls"]), float(r["precision"])),
                (section, "recall", str(r["cls"]), float(r["recall"])),
                (section, "f1", str(r["cls"]), float(r["f1"])),
                (section, "support", str(r["cls"]), float(r["support"]))]
    if rep:
        out.append((section, "accuracy", "", float(rep[0]["accuracy"])))
    return out


def segment_model(users: DataFrame, key: str = "user_id", label: str = "segment_label", k: int = 4) -> ModelResult:
    """ML-07: k-class segment classifier (depth 4, lr 0.1, sampling 0.8).  The
    classes share the softmax margins of a round, so their probabilities sum
    to 1; the fit stops on the multi-class log loss."""
    feats = _present(users, SEGMENT_FEATURES)
    d = _classifier_frame(users, feats, label, key)
    sec = "model2_segmentation"
    model, metrics = fit_boosted(d.filter("is_test = 0"), key, feats, sec, B.Params(
        loss="softmax", classes=k, rounds=100, depth=4, step=0.1, rows=0.8, columns=0.8, patience=10))
    probs = {f"segment_{c}_prob": F.col("_probs")[c] for c in range(k)}
    # argmax, first class wins ties
    best = (F.array_position("_probs", F.array_max("_probs")) - 1).cast("int").alias("predicted")
    scored = (model.transform(d.select(key, "is_test", "label", *feats), "_probs")
              .select(key, "is_test", "label", best, *[v.alias(n) for n, v in probs.items()]).checkpoint(eager=True))
    d.unpersist()
    metrics += _cls_metrics(scored.filter("is_test = 1"), sec) + _class_shares(scored, sec)
    metrics += _importances(model, feats, sec)
    return ModelResult("segment_model", scored, model, metrics)


def risk_model(users: DataFrame, key: str = "user_id", label: str = "risk_flag") -> ModelResult:
    """ML-08: imbalance-weighted binary risk classifier (depth 3, lr 0.1,
    sampling 0.8; positive training rows weighted neg/pos, validation rows
    not; the fit stops on the log loss)."""
    feats = _present(users, RISK_FEATURES)
    kept = d = _classifier_frame(users, feats, label, key)
    cnt = {r["label"]: r["n"] for r in d.filter("is_test = 0").groupBy("label").agg(F.count("*").alias("n")).collect()}
    w = (cnt.get(0, 0) / cnt[1]) if cnt.get(1) and cnt.get(0) else 1.0
    d = d.withColumn("weight", F.when((F.col("label") == 1) & ~F.col("is_val"), F.lit(float(w))).otherwise(F.lit(1.0)))
    sec = "model3_risk"
    model, facts = fit_boosted(d.filter("is_test = 0"), key, feats, sec, B.Params(
        loss="logistic", rounds=100, depth=3, step=0.1, rows=0.8, columns=0.8, patience=10))
    pred = model.transform(d.select(key, "is_test", "label", *feats), "risk_probability")
    pred = pred.select(key, "is_test", "label", (F.col("risk_probability") > 0.5).cast("int").alias("predicted"),
                       "risk_probability").checkpoint(eager=True)
    kept.unpersist()
    test = pred.filter("is_test = 1")
    metrics = facts + _cls_metrics(test, sec) + _class_shares(pred, sec)
    auc = M.roc_auc(test, "label", "risk_probability").first()["auc"]
    metrics.append((sec, "roc_auc", "", float(auc) if auc is not None else None))
    metrics += _importances(model, feats, sec)
    return ModelResult("risk_model", pred, model, metrics)


def cli_model(scored_users: DataFrame, key: str = "user_id") -> ModelResult:
    """ML-09 + RUL-18..21: increase-amount regressor on eligible users (200
    trees, depth 6, lr 0.1, sampling 0.8), target line x 1000 x max share,
    then the floor / cap post-processing on the full table."""
    from creditlens.operators.scoring import with_cli_features  # RUL-19 features
    eligible = F.col("segment_label").isin(0, 1)
    df = scored_users
    if "max_cli_percentage" not in df.columns:
        df = df.withColumn("max_cli_percentage", R.max_cli_pct("segment_label", "credit_score", "is_high_income"))
    e = with_cli_features(df.filter(eligible).drop("max_cli_percentage"))
    e = e.withColumn("label", F.col("credit_line") * 1000 * F.col("max_cli_percentage"))
    feats = _present(e, CLI_MODEL_FEATURES)
    e = materialise(S.hash_split(e, [key], 0.2, 42, "is_test"))
    sec = "model4_cli"
    model = B.fit(e.filter("is_test = 0"), [key], feats, B.Params(rounds=200, depth=6, step=0.1, rows=0.8, columns=0.8))
    pred = model.transform(e).checkpoint(eager=True)
    metrics = _reg_metrics(pred.filter("is_test = 1"), "label", "prediction", sec, "test")
    metrics += _importances(model, feats, sec)
    p = pred.select(key, F.col("prediction").alias("predicted_cli_amount"), "is_test")
    full = df.select(key, "segment_label", "credit_line", "is_high_income", "max_cli_percentage").join(p, key, "left")
    rec = R.cli_postprocess("predicted_cli_amount", "credit_line", "max_cli_percentage",
                            F.col("segment_label").isin(0, 1), "is_high_income")
    out = full.select(key, "is_test", "predicted_cli_amount", rec.alias("recommended_cli_amount"))
    e.unpersist()
    return ModelResult("cli_model", out, model, metrics)


def metrics_table(spark, results) -> DataFrame:
    """SRC-09 / ML-18: every metric as a (section, name, key, value) row."""
    rows = [r for res in results for r in res.metrics]
    return spark.createDataFrame(rows, "section string, name string, key string, value double")


def save_model(model: B.Boosted | PipelineModel, path: str) -> None:
    """SRC-10: the model as the new version at ``path``; if the write dies, the
    model before can still be loaded.  Spark ML models keep their own format."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, B.Boosted):
        row = spark.createDataFrame([(json.dumps(model.to_dict()),)], "boosted string")
        write_version(row, path, {"kind": "boosted", "trees": model.getNumTrees, "loss": model.params.loss})
    else:
        publish(spark, path, lambda folder: model.write().save(folder), {"kind": "pipeline"})


def save_models(results, folder: str) -> None:
    """SRC-10: every fitted model of a flow under ``folder``/stage (several
    models of a stage under ``folder``/stage/number)."""
    for res in results:
        many = isinstance(res.model, list)
        for k, model in enumerate(res.model if many else [res.model]):
            save_model(model, f"{folder}/{res.name}" + (f"/{k}" if many else ""))


def load_model(path: str) -> B.Boosted | PipelineModel:
    """The current version of a saved model."""
    spark = SparkSession.getActiveSession()
    at = current(spark, path)
    if at and at["facts"]["kind"] == "pipeline":
        return PipelineModel.load(at["folder"])
    return B.Boosted.from_dict(json.loads(read_version(spark, path).first()["boosted"]))

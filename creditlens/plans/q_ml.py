"""Model queries (rows-only checks: no exact SQL form for a boosted model).

Each returns the scored user table of one stage; ``full_flow`` chains the
four stages with failure isolation and ``model_metrics`` exposes the metrics
table of that run.
"""

from __future__ import annotations

import traceback

from pyspark.sql import functions as F

from creditlens.operators import metrics as M
from creditlens.operators import ml
from creditlens.operators import sampling as S
from creditlens.operators.prepare import initialise
from creditlens.operators.scoring import add_macro, rule_scores
from creditlens.plans import oracle_master as OM
from creditlens.plans import sqlparts as Q
from creditlens.plans.registry import query, scored_view, session_key, sig, sigs, user_view
from creditlens.sources import versions

_FLOW_CACHE: dict = {}


@query("q4_forecast")
def q4_forecast(spark, sf_dir):
    """ML-01 + ML-02 + ML-05 + ML-10 + ML-11 + ML-17."""
    return ml.q4_forecast(user_view(spark, sf_dir)).scored


@query("q3_backtest")
def q3_backtest(spark, sf_dir):
    """ML-06: Q3 back-test from Q1 + Q2."""
    return ml.q3_backtest(user_view(spark, sf_dir)).scored


@query("segment_model")
def segment_model(spark, sf_dir):
    """ML-03 + ML-04 + ML-07 + ML-13 + ML-14 + ML-15."""
    return ml.segment_model(user_view(spark, sf_dir)).scored


@query("risk_model")
def risk_model(spark, sf_dir):
    """ML-08 + ML-16: weighted binary risk classifier."""
    return ml.risk_model(user_view(spark, sf_dir)).scored


@query("cli_model")
def cli_model(spark, sf_dir):
    """ML-09 + RUL-19..21 on the rule-scored table."""
    return ml.cli_model(scored_view(spark, sf_dir)).scored


class Ledger:
    """Finished stages of a flow in a shared folder, each with its output, its
    model and its metrics, so that a later run begins where one failed.  A
    stage is current while the versions of the stages it read are; a stage
    that died has no entry."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _number(self, stage: str) -> int:
        at = versions.current(self.spark, f"{self.folder}/{stage}")
        return at["number"] if at else 0

    def finished(self, stage: str, reads=()) -> dict | None:
        """The entry of ``stage`` if it is current."""
        at = versions.current(self.spark, f"{self.folder}/{stage}")
        return at if at and at["facts"]["reads"] == {r: self._number(r) for r in reads} else None

    def record(self, stage: str, table, reads=(), **facts):
        """Write a stage's output and its entry; returns the output as read back."""
        versions.write_version(table, f"{self.folder}/{stage}", {"reads": {r: self._number(r) for r in reads}, **facts})
        return versions.read_version(self.spark, f"{self.folder}/{stage}")

    def result(self, stage: str, fn, reads=()):
        """The model result of ``stage``: the one on record, or that of ``fn()``, recorded."""
        at = self.finished(stage, reads)
        if at is None:
            res = fn()
            if isinstance(res.model, ml.B.Boosted):
                ml.save_model(res.model, f"{self.folder}/{stage}-model")
            res.scored = self.record(stage, res.scored, reads, metrics=res.metrics)
            return res
        model = f"{self.folder}/{stage}-model"
        return ml.ModelResult(stage, self.spark.read.parquet(at["folder"]),
                              ml.load_model(model) if versions.current(self.spark, model) else None,
                              [tuple(m) for m in at["facts"]["metrics"]])


class FlowError(RuntimeError):
    """A flow in which stages failed; ``table`` and ``metrics`` are what the others gave."""

    def __init__(self, errors, table, metrics):
        super().__init__("stages failed: " + "; ".join(f"{name} ({type(exc).__name__}: {exc})" for name, exc in errors))
        self.table, self.metrics = table, metrics


def run_flow(spark, sf_dir, save_to: str | None = None, ledger: str | None = None, whole: bool = False):
    """ML-19: initialise, then the model stages.  The Q4 forecast, the Q3
    back-test, the segment and the risk models read only the initialised
    table, so they are fitted concurrently; the increase-amount model
    consumes the forecast and the risk probability.  Each stage is isolated: a failure leaves its columns
    NULL, whatever the users had there, and records an error row in the metrics table.  With ``whole`` a
    flow with failures raises :class:`FlowError` once every stage has ended; none is kept for the next call.
    ``save_to`` names a folder that gets the fitted models.  ``ledger`` names a folder in which
    finished stages are recorded: a rerun reads them and runs only the others."""
    from concurrent.futures import ThreadPoolExecutor
    key = session_key(spark, sf_dir)
    if key in _FLOW_CACHE and save_to is None and ledger is None:
        return _FLOW_CACHE[key]
    book = Ledger(spark, ledger) if ledger else None
    start = book.finished("initialise") if book else None
    if start:
        base = spark.read.parquet(start["folder"])
    else:
        base = initialise(user_view(spark, sf_dir))
        base = book.record("initialise", base) if book else base.checkpoint(eager=True)
    results, errors = [], []

    def run(name, fn, table, reads):
        try:
            return book.result(name, lambda: fn(table), reads) if book else fn(table)
        except Exception as exc:  # noqa: BLE001 - stage isolation is the feature
            traceback.print_exc()
            errors.append((name, exc))
            return None

    def attach(table, res, cols):
        if res is None:
            return table.withColumns({c: F.lit(None).cast("double") for c in cols})
        results.append(res)
        keep = res.scored.select("user_id", *cols)
        return table.drop(*[c for c in cols if c in table.columns]).join(keep, "user_id", "left")

    stages = [("q4_forecast", ml.q4_forecast, ["predicted_q4_spend"]),
              ("q3_backtest", ml.q3_backtest, ["predicted_q3_spend"]),
              ("segment_model", ml.segment_model, [f"segment_{c}_prob" for c in range(4)]),
              ("risk_model", ml.risk_model, ["risk_probability"])]
    with ThreadPoolExecutor(max_workers=len(stages)) as pool:
        futures = [pool.submit(run, name, fn, base, ["initialise"]) for name, fn, _ in stages]
        outs = [f.result() for f in futures]
    table = base
    for (_, _, cols), res in zip(stages, outs):
        table = attach(table, res, cols)
    table = table.checkpoint(eager=True)

    def cli_stage(t):
        scored = rule_scores(t.drop("predicted_q4_spend")).drop("predicted_q4_spend")
        return ml.cli_model(scored.join(t.select("user_id", "predicted_q4_spend"), "user_id"))

    reads = ["initialise", "q4_forecast", "risk_model"]
    table = attach(table, run("cli_model", cli_stage, table, reads), ["recommended_cli_amount"]).checkpoint(eager=True)
    if save_to:
        ml.save_models(results, save_to)
    metrics = ml.metrics_table(spark, results)
    if errors:
        rows = [(name, "error", type(exc).__name__, None) for name, exc in errors]
        metrics = metrics.unionByName(spark.createDataFrame(rows, metrics.schema))
        if whole:
            raise FlowError(errors, table, metrics) from errors[0][1]
        return table, metrics
    _FLOW_CACHE[key] = (table, metrics)
    return table, metrics


@query("full_flow")
def full_flow(spark, sf_dir):
    """ML-19 + SRC-08: the scored user table with every stage's output; without
    one of them it raises."""
    return run_flow(spark, sf_dir, whole=True)[0]


@query("model_metrics")
def model_metrics(spark, sf_dir):
    """SRC-09 + ML-18 + ML-20: the metrics table of the flow, plus the
    re-evaluation on a 20 % hash sample of all scored rows."""
    from creditlens.functions import rules as R
    table, metrics = run_flow(spark, sf_dir)
    # ML-20: every stage re-scored on a 20 % hash sample of all scored rows
    # (training rows included, reported apart from the held-out metrics)
    smp = S.sample_fraction(table, ["user_id"], 0.2, 42).checkpoint(eager=True)
    sec = "sample_reevaluation"
    extra = []
    if "predicted_q4_spend" in smp.columns:
        r = M.regression_metrics(smp, "spend_2024_q4", "predicted_q4_spend").first()
        extra += [(sec, f"q4_{k}", "", float(v) if v is not None else None) for k, v in r.asDict().items()]
    probs = [f"segment_{c}_prob" for c in range(4)]
    if all(p in smp.columns for p in probs):
        arr = F.array(*[F.col(p) for p in probs])
        seg = smp.select(F.col("segment_label").alias("label"),
                         (F.array_position(arr, F.array_max(arr)) - 1).cast("int").alias("predicted"))
        acc = seg.select(F.avg((F.col("label") == F.col("predicted")).cast("double"))).first()[0]
        extra.append((sec, "segment_accuracy", "", float(acc) if acc is not None else None))
    if "risk_probability" in smp.columns:
        auc = M.roc_auc(smp, "risk_flag", "risk_probability").first()["auc"]
        extra.append((sec, "risk_roc_auc", "", float(auc) if auc is not None else None))
    if "recommended_cli_amount" in smp.columns:
        e = smp.filter(F.col("segment_label").isin(0, 1)).withColumn(
            "target", F.col("credit_line") * 1000 * R.max_cli_pct("segment_label", "credit_score", "is_high_income"))
        r = M.regression_metrics(e, "target", "recommended_cli_amount").first()
        extra += [(sec, f"cli_{k}", "", float(v) if v is not None else None) for k, v in r.asDict().items()]
    return metrics.unionByName(spark.createDataFrame(extra, metrics.schema))


# ------------------------------------------- the exact parts of the models

_GAPS = {  # missing and infinite inputs, by key
    "credit_score": ("CASE WHEN user_id % 17 = 0 THEN NULL ELSE credit_score END",
                     lambda: F.when(F.col("user_id") % 17 != 0, F.col("credit_score"))),
    "current_balance": ("CASE WHEN user_id % 29 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE current_balance END",
                        lambda: F.when(F.col("user_id") % 29 == 0, F.lit(float("inf"))).otherwise(F.col("current_balance"))),
}


def _q4_matrix_sql() -> str:
    m = Q.macro_sql()
    cols = [c for c in ml.Q4_FEATURES if c != "q4_adjustment_factor"]
    raw = ", ".join(f"{_GAPS[c][0] if c in _GAPS else c} AS {c}" for c in ["user_id", *cols, "spend_2024_q4"])
    grow = "CASE WHEN spend_2024_q2 > 0 THEN (spend_2024_q3 - spend_2024_q2) / greatest(1.0, spend_2024_q2) ELSE 0.0 END"
    names = [*ml.Q4_FEATURES, "q2_to_q3_growth", "high_income_credit_capacity"]
    fills = ", ".join(f"coalesce({c}, (SELECT q0 FROM ({Q.quantile_sql('mx', c, [0.5])}))) AS {c}" for c in names)
    finite = ", ".join(f"CASE WHEN isinf(CAST({c} AS DOUBLE)) OR isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}"
                       for c in names)
    return OM.user_view_ctes() + f""",
g AS (SELECT {raw} FROM um),
f AS (SELECT *, {m['q4_adjustment_factor']} AS q4_adjustment_factor,
             least(greatest({grow}, -5.0), 5.0) AS q2_to_q3_growth, is_high_income * credit_line AS high_income_credit_capacity FROM g),
mx AS (SELECT user_id, {finite}, greatest(CAST(spend_2024_q4 AS DOUBLE), 0.01) AS label FROM f)
SELECT user_id, {fills}, label FROM mx"""


@query("q4_matrix", _q4_matrix_sql)
def q4_matrix(spark, sf_dir):
    """ML-01: the model matrix of the Q4 forecast over users with missing and
    infinite inputs."""
    u = user_view(spark, sf_dir).withColumns({c: value() for c, (_, value) in _GAPS.items()})
    d, cols = ml.q4_matrix(u)
    return d.select("user_id", *cols, "label")


@query("q4_adjustment", lambda: OM.user_view_ctes() + f"""
SELECT user_id, spend_2024_q4 * (0.8 + 0.2 * {Q.macro_sql()['q4_adjustment_factor']}) AS adjusted FROM um""")
def q4_adjustment(spark, sf_dir):
    """ML-10: the seasonal adjustment, applied to the actual Q4 spend."""
    u = add_macro(user_view(spark, sf_dir))
    return u.select("user_id", ml.q4_adjusted(F.col("spend_2024_q4"), F.col("q4_adjustment_factor")).alias("adjusted"))


@query("sample_reevaluation", lambda: OM.scored_ctes() + f""",
d AS (SELECT spend_2024_q4 AS y, predicted_q4_spend AS p FROM scored
      WHERE {S.hash_fraction_sql(['user_id'], 42)} < 0.2 AND spend_2024_q4 IS NOT NULL AND predicted_q4_spend IS NOT NULL),
a AS (SELECT count(*) AS n, avg((y - p) * (y - p)) AS mse, var_pop(y) AS vy, avg(abs((y - p) / greatest(y, 1.0))) AS ape, avg(y) AS my FROM d)
SELECT n, {sigs('mse')} AS mse, {sigs('sqrt(mse)')} AS rmse, {sigs('1.0 - mse / vy')} AS r2, {sigs('ape * 100')} AS mape,
       {sigs('sqrt(mse) / my * 100')} AS rmse_pct_of_mean FROM a""")
def sample_reevaluation(spark, sf_dir):
    """ML-20: the rule-based Q4 forecast evaluated on a 20 % hash sample of all users."""
    smp = S.sample_fraction(scored_view(spark, sf_dir), ["user_id"], 0.2, 42)
    m = M.regression_metrics(smp, "spend_2024_q4", "predicted_q4_spend")
    return m.select("n", *[sig(c).alias(c) for c in ("mse", "rmse", "r2", "mape", "rmse_pct_of_mean")])

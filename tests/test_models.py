"""Invariants of the model stages (SURVEY §5 (c)); trained at sf0.01 (sf0.001
has a one-user class)."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from creditlens.functions import rules as R
from creditlens.operators import ml
from creditlens.plans.registry import scored_view, user_view


@pytest.fixture(scope="module")
def users(spark):
    return user_view(spark, SF_MID)


def test_segment_probabilities(users):
    res = ml.segment_model(users)
    s = res.scored
    assert s.count() == users.count()
    total = sum((F.col(f"segment_{c}_prob") for c in range(4)), F.lit(0.0))
    bad = s.filter((F.abs(total - 1) > 1e-9) | (F.least(*[F.col(f"segment_{c}_prob") for c in range(4)]) < 0)
                   | (F.greatest(*[F.col(f"segment_{c}_prob") for c in range(4)]) > 1)).count()
    assert bad == 0
    names = {m[1] for m in res.metrics}
    assert {"accuracy", "precision", "recall", "f1", "class_share", "feature_importance"} <= names


def test_risk_probabilities_and_auc(users):
    res = ml.risk_model(users)
    assert res.scored.filter((F.col("risk_probability") < 0) | (F.col("risk_probability") > 1)).count() == 0
    auc = [m[3] for m in res.metrics if m[1] == "roc_auc"][0]
    assert auc is None or 0.0 <= auc <= 1.0
    m = {x[1]: x[3] for x in res.metrics if not x[2]}
    assert m["last_round"] == 100 or m["last_round"] - m["best_round"] == m["patience"]


def test_q4_forecast_beats_the_mean(users):
    res = ml.q4_forecast(users)
    assert res.scored.count() == users.count()
    r2 = [m[3] for m in res.metrics if m[1] == "test_r2"][0]
    assert r2 > 0  # held-out error below predicting the held-out mean


def test_patience_rule():
    assert ml.stopping_round([5, 4, 3, 3.5, 3.2, 2.9, 3, 3, 3], 3) == (6, 9)
    assert ml.stopping_round([5, 4, 4, 4, 4, 1], 3) == (2, 5)
    assert ml.stopping_round([3.0], 10) == (1, 1)


def test_fits_run_until_their_patience_ends_and_beat_one_tree(users):
    """The back-test on a target its inputs do carry (the given quarters are unrelated)."""
    t = users.withColumn("spend_2024_q3", F.col("spend_2024_q1") * 0.5 + F.col("spend_2024_q2") * 0.8
                         + F.col("credit_line") * 20)
    res = ml.q3_backtest(t)
    m = {x[1]: x[3] for x in res.metrics if not x[2]}
    assert m["trees"] == m["best_round"] and (m["last_round"] == 100 or m["last_round"] - m["best_round"] == m["patience"])
    assert m["trees"] > 10
    assert m["test_r2"] > 0.5  # one tree with step 0.1 explains far less
    one = res.model.stages[-1].treeWeights[0]
    assert one == 1.0 and res.model.stages[-1].getNumTrees == m["trees"]


def test_models_release_their_tables_and_can_be_saved(spark, users, tmp_path):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    res = ml.risk_model(users)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    many = ml.ModelResult("segment_model", None, [res.model, res.model], [])
    ml.save_models([res, many], str(tmp_path))
    again = ml.load_model(f"{tmp_path}/segment_model/1")
    assert again.stages[-1].getNumTrees == res.model.stages[-1].getNumTrees


def test_a_failing_stage_leaves_nulls_and_an_error_row(spark, monkeypatch):
    from creditlens.plans import q_ml

    def fail(users):
        raise ValueError("no rows")

    def flat(name, cols):
        def stage(table):
            return ml.ModelResult(name, table.select("user_id", *[F.lit(0.25).alias(c) for c in cols]), None,
                                  [(name, "trees", "", 1.0)])
        return stage

    monkeypatch.setattr(ml, "q4_forecast", flat("q4_forecast", ["predicted_q4_spend"]))
    monkeypatch.setattr(ml, "q3_backtest", fail)
    monkeypatch.setattr(ml, "segment_model", flat("segment_model", [f"segment_{c}_prob" for c in range(4)]))
    monkeypatch.setattr(ml, "risk_model", flat("risk_model", ["risk_probability"]))
    monkeypatch.setattr(ml, "cli_model", flat("cli_model", ["recommended_cli_amount"]))
    monkeypatch.setattr(q_ml, "_FLOW_CACHE", {})
    table, metrics = q_ml.run_flow(spark, SF_MID)
    assert table.filter("predicted_q3_spend is not null").count() == 0
    assert table.filter("recommended_cli_amount = 0.25").count() == table.count()
    assert metrics.filter("section = 'q3_backtest' and name = 'error' and key = 'ValueError'").count() == 1


def test_a_rerun_starts_at_the_failed_stage(spark, monkeypatch, tmp_path):
    from creditlens.plans import q_ml
    from creditlens.sources import versions
    ran, broken = [], {"risk_model"}

    def flat(name, cols):
        def stage(table):
            ran.append(name)
            if name in broken:
                raise ValueError("lost")
            value = F.lit(0.25) if name != "risk_model" else F.lit(0.5)
            return ml.ModelResult(name, table.select("user_id", *[value.alias(c) for c in cols]), None, [(name, "trees", "", 1.0)])
        return stage

    for name, cols in (("q4_forecast", ["predicted_q4_spend"]), ("q3_backtest", ["predicted_q3_spend"]),
                       ("segment_model", [f"segment_{c}_prob" for c in range(4)]), ("risk_model", ["risk_probability"]),
                       ("cli_model", ["recommended_cli_amount"])):
        monkeypatch.setattr(ml, name, flat(name, cols))
    monkeypatch.setattr(q_ml, "_FLOW_CACHE", {})
    folder = str(tmp_path)
    table, metrics = q_ml.run_flow(spark, SF_MID, ledger=folder)
    assert sorted(ran) == ["cli_model", "q3_backtest", "q4_forecast", "risk_model", "segment_model"]
    assert metrics.where("name = 'error'").count() == 1 and versions.current(spark, f"{folder}/risk_model") is None
    ran.clear()
    broken.clear()
    table, metrics = q_ml.run_flow(spark, SF_MID, ledger=folder)
    # the failed stage, and the one that reads it
    assert sorted(ran) == ["cli_model", "risk_model"]
    assert metrics.where("name = 'error'").count() == 0 and metrics.count() == 5
    assert table.where("risk_probability = 0.5 and predicted_q3_spend = 0.25 and recommended_cli_amount = 0.25").count() == table.count()
    ran.clear()
    q_ml.run_flow(spark, SF_MID, ledger=folder)
    assert ran == []


def test_a_flow_with_a_failed_stage_is_no_result(spark, monkeypatch):
    from creditlens.plans import q_ml
    broken, broke = {"risk_model"}, ValueError("lost")

    def flat(name, cols):
        def stage(table):
            if name in broken:
                raise broke
            return ml.ModelResult(name, table.select("user_id", *[F.lit(0.25).alias(c) for c in cols]), None, [(name, "trees", "", 1.0)])
        return stage

    for name, cols in (("q4_forecast", ["predicted_q4_spend"]), ("q3_backtest", ["predicted_q3_spend"]),
                       ("segment_model", [f"segment_{c}_prob" for c in range(4)]), ("risk_model", ["risk_probability"]),
                       ("cli_model", ["recommended_cli_amount"])):
        monkeypatch.setattr(ml, name, flat(name, cols))
    monkeypatch.setattr(q_ml, "_FLOW_CACHE", {})
    rows = [(1, 0, 0.9), (2, 1, 0.1), (3, 2, 0.2), (4, 3, 0.3)]  # with the rules' risk_probability
    users = (spark.createDataFrame(rows, "user_id long, segment_label int, risk_probability double")
             .withColumns({c: F.col("user_id") * 10.0 for c in ("credit_line", "credit_score", "utilization_pct", "current_balance",
                                                              "total_spend_2024", "spend_2024_q1", "spend_2024_q2",
                                                              "spend_2024_q3", "spend_2024_q4")})
             .withColumns({"is_high_income": F.lit(1), "risk_flag": (F.col("user_id") == 1).cast("int")}))
    monkeypatch.setattr(q_ml, "user_view", lambda spark, sf_dir: users)
    with pytest.raises(q_ml.FlowError, match="risk_model") as failed:
        q_ml.full_flow(spark, "four users")
    assert failed.value.__cause__ is broke
    # what the other stages gave is there, the rules' values do not stand in for the model's
    table, metrics = failed.value.table, failed.value.metrics
    assert table.where("risk_probability is null and predicted_q4_spend = 0.25 and recommended_cli_amount = 0.25").count() == 4
    assert metrics.where("section = 'risk_model' and name = 'error' and key = 'ValueError'").count() == 1
    told = {(m["section"], m["name"]): m["value"] for m in q_ml.model_metrics(spark, "four users").collect()}
    assert ("risk_model", "error") in told and told["sample_reevaluation", "risk_roc_auc"] is None
    # and it is not kept for the next call
    broken.clear()
    assert q_ml.full_flow(spark, "four users").where("risk_probability = 0.25").count() == 4
    assert q_ml.model_metrics(spark, "four users").where("name = 'error'").count() == 0


def test_stages_that_begin_together_ship_the_package_once():
    import time
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace
    from creditlens.session import ship
    sent = []

    def add(path):
        time.sleep(0.2)
        if sent:
            raise ValueError("a file of that name is there already")
        sent.append(path)

    session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId=f"app-{time.time_ns()}", addPyFile=add))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(ship, [session] * 4))
    assert len(sent) == 1


def test_stages_without_any_spend_are_scored(spark):
    """R^2 and the share of the mean are undefined there, the predictions are not."""
    users = spark.range(1, 41).select(F.col("id").alias("user_id"), *[F.lit(0.0).alias(c) for c in ml.Q3_FEATURES],
                                      F.lit(0.0).alias("spend_2024_q3"))
    res = ml.q3_backtest(users)
    assert res.scored.where("predicted_q3_spend = 0").count() == 40
    m = {x[1]: x[3] for x in res.metrics if not x[2]}
    assert m["full_n"] == 40 and m["full_mse"] == 0 and m["full_r2"] is None and m["full_rmse_pct_of_mean"] is None


def test_cli_amount_rules(spark):
    s = scored_view(spark, SF_MID)
    res = ml.cli_model(s)
    j = res.scored.join(s.select("user_id", "segment_label", "credit_line", "credit_score", "is_high_income"), "user_id")
    cap = F.col("credit_line") * 1000 * R.max_cli_pct("segment_label", "credit_score", "is_high_income")
    assert j.filter(F.col("segment_label").isin(2, 3) & (F.col("recommended_cli_amount") != 0)).count() == 0
    over = j.filter(F.col("segment_label").isin(0, 1)
                    & (F.col("recommended_cli_amount") > F.greatest(F.lit(500.0), cap) + 1e-6)).count()
    assert over == 0

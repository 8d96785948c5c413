"""The role tables hold real groups, so grouped results cannot equal their input."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from creditlens.plans import registry
from creditlens.sources import roles
from creditlens.sources.tables import Tables

registry.load_all()


def test_accounts_have_several_statements_and_frauds(spark):
    t = Tables(spark, SF_SMALL)
    assert roles.fraud_claim_tran(t).count() == t.events.where("event_type = 'error'").count()
    for table in (roles.statement_fact(t), roles.fraud_claim_tran(t)):
        per = table.groupBy("current_account_nbr").count().agg(F.max("count"), F.avg("count")).first()
        assert per[0] > 1 and per[1] > 1
        assert table.join(roles.account_dim(t), "current_account_nbr", "left_anti").count() == 0
    assert roles.statement_fact(t).select(F.trunc("billing_cycle_date", "MM")).distinct().count() >= 12


def test_history_holds_a_code_per_month(spark):
    a = roles.account_dim(Tables(spark, SF_SMALL))
    for c in ("payment_hist_1_12_mths", "payment_hist_13_24_mths"):
        assert 1 < a.agg(F.max(F.length(c))).first()[0] <= 12


def test_history_of_a_hot_account_stays_short(spark):
    class Hot:
        lineitem = spark.range(20_000).select(
            F.lit(1).cast("long").alias("l_orderkey"), F.col("id").alias("l_partkey"),
            F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") % 700).cast("int")).cast("timestamp_ntz").alias("l_shipdate"))
    row = roles.line_summary(Hot).first()
    assert len(row["payment_hist_1_12_mths"]) == 12 and len(row["payment_hist_13_24_mths"]) == 6


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")


def test_business_days_and_trend_scan_lineitem_once(spark):
    assert _scans(registry.QUERIES["business_days_between"](spark, SF_SMALL)) == 1
    trend = registry.QUERIES["monthly_spend_trend"](spark, SF_SMALL)
    assert _scans(trend) == 1
    assert "GreaterThanOrEqual(l_shipdate" in trend._jdf.queryExecution().executedPlan().toString()

"""Report queries: time series, profiles, descriptive statistics and the
business reports over the (rule-scored) user table."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions import rules as R
from creditlens.operators import reports as RP
from creditlens.operators import sampling as S
from creditlens.plans import oracle_master as OM
from creditlens.plans import sqlparts as Q
from creditlens.plans.registry import query, r6, r6s, scored_view, user_view
from creditlens.sources import roles
from creditlens.sources.roles import PERIODS, with_roles
from creditlens.sources.tables import Tables

# ------------------------------------------------------------ time series


def _income_by_account(t):
    return roles.account_dim(t).select("current_account_nbr",
                                       R.income_from_code("employee_code").alias("is_high_income"))


def _bcm_sql() -> str:
    return with_roles("statement_fact", "account_dim") + """,
m AS (SELECT s.*, CASE WHEN a.employee_code IS NULL OR a.employee_code = 'Y' THEN 0
                       WHEN a.employee_code = 'H' THEN 1 END AS is_high_income
      FROM statement_fact s LEFT JOIN account_dim a ON a.current_account_nbr = s.current_account_nbr)
SELECT CAST(make_date(year(billing_cycle_date), month(billing_cycle_date), 15) AS VARCHAR) AS billing_cycle_date_15th,
       is_high_income, CAST(sum(prev_balance) AS DOUBLE) / count(prev_balance) AS avg_prev_balance,
       count(*) AS n_statements
FROM m WHERE is_high_income IN (0, 1) GROUP BY 1, 2"""


@query("billing_cycle_mean_balance", _bcm_sql)
def billing_cycle_mean_balance(spark, sf_dir):
    """JOIN-07 + DAT-04 + FLT-01 + AGG-09: mean previous balance per
    mid-month billing bucket, one series per income group."""
    t = Tables(spark, sf_dir)
    m = roles.statement_fact(t).join(_income_by_account(t), "current_account_nbr", "left")
    d15 = F.make_date(F.year("billing_cycle_date"), F.month("billing_cycle_date"), F.lit(15))
    return (m.filter(F.col("is_high_income").isin(0, 1))
            .groupBy(d15.cast("string").alias("billing_cycle_date_15th"), "is_high_income")
            .agg((F.sum("prev_balance").cast("double") / F.count("prev_balance")).alias("avg_prev_balance"),
                 F.count("*").alias("n_statements")))


def _mst_sql() -> str:
    lo, hi = PERIODS.year[0][:4], PERIODS.ytd[0][:4]
    return with_roles("domestic_transactions", "foreign_transactions") + f""",
u AS (SELECT *, NULL AS us_equiv_amt FROM domestic_transactions UNION ALL BY NAME SELECT * FROM foreign_transactions)
SELECT CAST(CAST(date_trunc('month', transaction_date) AS DATE) AS VARCHAR) AS year_month,
       CAST(coalesce(sum(us_equiv_amt), 0) AS DOUBLE) AS total_spend, count(*) AS n_sales
FROM u WHERE transaction_type = 'SALE'
GROUP BY 1 HAVING year(CAST(year_month AS DATE)) BETWEEN {lo} AND {hi}"""


@query("monthly_spend_trend", _mst_sql)
def monthly_spend_trend(spark, sf_dir):
    """SET-01 + FLT-01 + DAT-05 + AGG-11 + FLT-06: monthly sum of converted
    sales (pandas sums skip missing conversions), reporting years only."""
    t = Tables(spark, sf_dir)
    lo, hi = int(PERIODS.year[0][:4]), int(PERIODS.ytd[0][:4])
    month = F.trunc("transaction_date", "MM")
    span = F.col("transaction_date").between(F.lit(f"{lo}-01-01").cast("date"), F.lit(f"{hi}-12-31").cast("date"))
    return (roles.transactions(t).filter(span & (F.col("transaction_type") == "SALE"))
            .groupBy(month.alias("ym"))
            .agg(F.coalesce(F.sum("us_equiv_amt"), F.lit(0)).cast("double").alias("total_spend"),
                 F.count("*").alias("n_sales"))
            .select(F.col("ym").cast("string").alias("year_month"), "total_spend", "n_sales"))


def _bfd_sql() -> str:
    return OM.user_view_ctes() + """,
m AS (SELECT s.current_account_nbr, s.billing_cycle_date, s.prev_balance,
             CASE WHEN a.employee_code IS NULL OR a.employee_code = 'Y' THEN 0
                  WHEN a.employee_code = 'H' THEN 1 END AS is_high_income,
             u.has_fraud
      FROM statement_fact s LEFT JOIN account_dim a ON a.current_account_nbr = s.current_account_nbr
      LEFT JOIN identity_map i ON i.account_nbr_pty = s.current_account_nbr
      LEFT JOIN um u ON u.user_id = i.ds_id)
SELECT is_high_income, CAST(billing_cycle_date AS VARCHAR) AS billing_cycle_date,
       CAST(sum(prev_balance) AS DOUBLE) / count(prev_balance) AS avg_prev_balance, max(has_fraud) AS has_fraud
FROM m WHERE is_high_income IN (0, 1) GROUP BY 1, 2 HAVING max(has_fraud) = 1"""


@query("balance_fraud_by_date", _bfd_sql)
def balance_fraud_by_date(spark, sf_dir):
    """JOIN-05 (differently named keys) + JOIN-06 (left-join chain) +
    AGG-10: all statements joined to income, user and the user fraud flag;
    mean balance and fraud flag per date, fraud dates only."""
    t = Tables(spark, sf_dir)
    u = user_view(spark, sf_dir).select("user_id", "has_fraud")
    idm = roles.identity_map(t).select("account_nbr_pty", "ds_id")
    s = roles.statement_fact(t).drop("user_id")
    m = (s.join(_income_by_account(t), "current_account_nbr", "left")
         .join(idm, s.current_account_nbr == idm.account_nbr_pty, "left").drop("account_nbr_pty")
         .withColumnRenamed("ds_id", "user_id")
         .join(u, "user_id", "left"))
    return (m.filter(F.col("is_high_income").isin(0, 1)).groupBy("is_high_income", F.col("billing_cycle_date").cast("string").alias("billing_cycle_date"))
            .agg((F.sum("prev_balance").cast("double") / F.count("prev_balance")).alias("avg_prev_balance"),
                 F.max("has_fraud").alias("has_fraud"))
            .filter(F.col("has_fraud") == 1))


def _ft_sql() -> str:
    return with_roles("fraud_claim_case", "fraud_claim_tran") + """
SELECT * FROM (
  SELECT 'case' AS kind, case_id, current_account_nbr, CAST(reported_date AS VARCHAR) AS event_date,
         CAST(gross_fraud_amt AS DOUBLE) AS amount FROM fraud_claim_case
  UNION ALL
  SELECT 'transaction' AS kind, case_id, current_account_nbr, CAST(transaction_dt AS VARCHAR) AS event_date,
         CAST(transaction_am AS DOUBLE) AS amount FROM fraud_claim_tran)
ORDER BY event_date, kind, case_id, current_account_nbr"""


@query("fraud_timeline", _ft_sql)
def fraud_timeline(spark, sf_dir):
    """SRT-03: fraud cases and fraud transactions in event-date order."""
    t = Tables(spark, sf_dir)
    c = roles.fraud_claim_case(t).select(F.lit("case").alias("kind"), "case_id", "current_account_nbr",
                                         F.col("reported_date").cast("string").alias("event_date"),
                                         F.col("gross_fraud_amt").cast("double").alias("amount"))
    x = roles.fraud_claim_tran(t).select(F.lit("transaction").alias("kind"), "case_id", "current_account_nbr",
                                         F.col("transaction_dt").cast("string").alias("event_date"),
                                         F.col("transaction_am").cast("double").alias("amount"))
    return c.unionByName(x).orderBy("event_date", "kind", "case_id", "current_account_nbr")


def _age_sql() -> str:
    return with_roles("account_dim") + f"""
SELECT current_account_nbr, CAST(open_date AS VARCHAR) AS open_date,
       CAST(card_activation_date AS VARCHAR) AS card_activation_date,
       CAST(DATE '{PERIODS.ref_date}' - open_date AS INTEGER) AS account_age_days,
       CASE WHEN card_activation_date IS NOT NULL AND open_date IS NOT NULL
            THEN CAST(floor(epoch(CAST(card_activation_date AS TIMESTAMP) - CAST(open_date AS TIMESTAMP)) / 86400) AS BIGINT)
       END AS activation_delay_days
FROM account_dim"""


@query("account_age", _age_sql)
def account_age(spark, sf_dir):
    """DAT-07 + DAT-08: account age at the reference date and activation
    delay (floor of elapsed seconds / 86400, only where both dates exist)."""
    a = roles.account_dim(Tables(spark, sf_dir))
    ref = F.lit(PERIODS.ref_date).cast("date")
    # elapsed seconds between wall-clock values (no time zone: DST cannot shift the day count)
    secs = F.timestamp_diff("SECOND", F.col("open_date").cast("timestamp_ntz"),
                            F.col("card_activation_date").cast("timestamp_ntz"))
    both = F.col("card_activation_date").isNotNull() & F.col("open_date").isNotNull()
    return a.select("current_account_nbr", F.col("open_date").cast("string").alias("open_date"),
                    F.col("card_activation_date").cast("string").alias("card_activation_date"),
                    F.datediff(ref, "open_date").alias("account_age_days"),
                    F.when(both, F.floor(secs / 86400)).cast("long").alias("activation_delay_days"))


# ---------------------------------------------------------------- profiles

PROFILE_COLS = ["current_account_nbr", "client_id", "open_date", "card_activation_date", "closed_date",
                "employee_code", "ebill_ind", "pscc_ind", "external_status_reason_code",
                "ext_status_reason_cd_desc", "payment_hist_1_12_mths", "payment_hist_13_24_mths",
                "date_in_collection", "special_finance_charge_ind"]


def _null_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM account_dim"
        for c in PROFILE_COLS)
    return with_roles("account_dim") + f"\nSELECT * FROM ({parts}) ORDER BY null_count DESC, column_name"


@query("null_profile", _null_sql)
def null_profile(spark, sf_dir):
    """AGG-23: null count per column (one aggregate pass), sorted descending."""
    a = roles.account_dim(Tables(spark, sf_dir))
    return RP.null_counts(a.select(*PROFILE_COLS)).orderBy(F.desc("null_count"), "column_name")


def _profile_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"count(DISTINCT {c}) AS n_distinct FROM account_dim" for c in PROFILE_COLS)
    return with_roles("account_dim") + f"\nSELECT * FROM ({parts})"


@query("table_profile", _profile_sql)
def table_profile(spark, sf_dir):
    """AGG-24: rows, nulls and distinct values per column."""
    a = roles.account_dim(Tables(spark, sf_dir))
    return RP.column_profile(a.select(*PROFILE_COLS))


DESCRIBE_COLS = ["credit_line", "utilization_pct", "total_spend_2024", "credit_score"]


def _describe_sql(cols, group=None) -> str:
    g_sel = f"{group}, " if group else ""
    g_by = f" GROUP BY {group}" if group else ""
    parts = []
    for c in cols:
        qs = Q.quantile_sql("um", c, [0.25, 0.5, 0.75], group, ["p25", "p50", "p75"])
        join = f"USING ({group})" if group else "ON true"
        parts.append(f"""SELECT {'a.' + group + ', ' if group else ''}'{c}' AS column_name, a.count, a.mean, a.std, a.min,
  {r6s('q.p25')} AS p25, {r6s('q.p50')} AS p50, {r6s('q.p75')} AS p75, a.max
  FROM (SELECT {g_sel}count({c}) AS count, {r6s(f'avg({c})')} AS mean, {r6s(f'stddev_samp({c})')} AS std,
               min({c}) AS min, max({c}) AS max FROM um{g_by}) a JOIN ({qs}) q {join}""")
    return OM.user_view_ctes() + "\n" + " UNION ALL ".join(parts)


@query("describe_credit_line", lambda: _describe_sql(["credit_line"]))
def describe_credit_line(spark, sf_dir):
    """AGG-14 / AGG-34: count, mean, sample std, min, quartiles, max."""
    return RP.describe(user_view(spark, sf_dir), ["credit_line"])


@query("describe_by_group", lambda: _describe_sql(DESCRIBE_COLS, "is_high_income"))
def describe_by_group(spark, sf_dir):
    """AGG-14 per income group over four columns (one unpivot + one
    aggregate, a single shuffle)."""
    return RP.describe(user_view(spark, sf_dir), DESCRIBE_COLS, group="is_high_income")


def _topk_sql() -> str:
    return OM.user_view_ctes() + """,
d AS (SELECT CAST((payment_hist_1_12_delinquency_count >= 1 OR payment_hist_13_24_delinquency_count >= 1)
                  AS INTEGER) AS delinquent, credit_line FROM um),
f AS (SELECT delinquent, credit_line, count(*) AS n FROM d GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY delinquent ORDER BY n DESC, credit_line) AS INTEGER)
                     AS rank FROM f)
WHERE rank <= 20"""


@query("frequency_topk", _topk_sql)
def frequency_topk(spark, sf_dir):
    """FLT-04 + AGG-15 + SRT-02: the 20 most frequent credit lines among
    delinquent and non-delinquent users (per-group limit; Spark inserts a
    partial top-k before the shuffle)."""
    u = user_view(spark, sf_dir)
    d = u.select(((F.col("payment_hist_1_12_delinquency_count") >= 1)
                  | (F.col("payment_hist_13_24_delinquency_count") >= 1)).cast("int").alias("delinquent"),
                 "credit_line")
    return RP.top_k_frequent(d, "delinquent", "credit_line", 20)


CORR_TARGET = "total_spend_2025YTD"


def _corr_cols():
    return [c for c in OM.USER_NUMERIC if c != CORR_TARGET] + [
        "delinquency_12mo", "delinquency_24mo", "risk_flag", "segment_label", "risk_probability"]


def _corr_sql() -> str:
    def pw(a, b):
        return f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN stddev_pop({pw(c, CORR_TARGET)}) * stddev_pop({pw(CORR_TARGET, c)}) > 0 "
        f"THEN {r6s(f'covar_pop({pw(c, CORR_TARGET)}, {pw(CORR_TARGET, c)}) / (stddev_pop({pw(c, CORR_TARGET)}) * stddev_pop({pw(CORR_TARGET, c)}))')} "
        f"END AS corr FROM um" for c in _corr_cols())
    return OM.user_view_ctes() + "\n" + parts


@query("corr_with_target", _corr_sql)
def corr_with_target(spark, sf_dir):
    """AGG-22: Pearson correlation of every numeric column with the target
    (one aggregate row, unpivoted)."""
    return RP.corr_with(user_view(spark, sf_dir), _corr_cols(), CORR_TARGET)


def _iq_sql() -> str:
    qs = Q.quantile_sql("e", "recommended_cli_amount", [0.25, 0.5, 0.75])
    return OM.scored_ctes() + f""",
e AS (SELECT * FROM scored WHERE segment_label IN (0, 1))
SELECT (SELECT count(*) FROM e) AS n_eligible, {r6s('q0')} AS q25, {r6s('q1')} AS q50, {r6s('q2')} AS q75
FROM ({qs})"""


@query("increase_quantiles", _iq_sql)
def increase_quantiles(spark, sf_dir):
    """FLT-05 + AGG-17: exact quartiles of the recommended increase."""
    s = scored_view(spark, sf_dir).filter(F.col("segment_label").isin(0, 1))
    q = RP.quantile_table(s, "recommended_cli_amount", [0.25, 0.5, 0.75], names=["_a", "_b", "_c"])
    return q.select(s.select(F.count("*")).scalar().alias("n_eligible"),
                    r6(F.col("_a")).alias("q25"), r6(F.col("_b")).alias("q50"), r6(F.col("_c")).alias("q75"))


# -------------------------------------------------------- business reports

def _dsum(c: str) -> str:
    """exact sum of a DOUBLE column (twin of reports.exact_sum)."""
    return f"sum(CAST({c} AS DECIMAL(38,9)))"


def _clsi_sql() -> str:
    return OM.scored_ctes() + f"""
SELECT segment_label, is_high_income, {r6s('avg(credit_line) * 1000')} AS avg_credit_line_usd,
       {r6s('avg(utilization_pct)')} AS avg_utilization_pct, count(*) AS n_users
FROM scored GROUP BY GROUPING SETS ((segment_label), (is_high_income))"""


@query("credit_line_by_segment_income", _clsi_sql)
def credit_line_by_segment_income(spark, sf_dir):
    """AGG-18: mean line (USD), mean utilisation and count by segment and
    by income in one GROUPING SETS aggregate."""
    s = scored_view(spark, sf_dir)
    return (s.groupingSets([["segment_label"], ["is_high_income"]], "segment_label", "is_high_income")
            .agg(r6(F.avg("credit_line") * 1000).alias("avg_credit_line_usd"),
                 r6(F.avg("utilization_pct")).alias("avg_utilization_pct"),
                 F.count("*").alias("n_users")))


def _ratio_sql() -> str:
    return OM.scored_ctes() + f""",
e AS (SELECT * FROM scored WHERE segment_label IN (0, 1))
SELECT 'all' AS scope, {r6s(f'CAST({_dsum("credit_line")} AS DOUBLE) * 1000')} AS current_credit,
       {r6s(f'CAST({_dsum("recommended_cli_amount")} AS DOUBLE)')} AS total_cli,
       {r6s(f'CAST({_dsum("recommended_cli_amount")} AS DOUBLE) / (CAST({_dsum("credit_line")} AS DOUBLE) * 1000) * 100')} AS pct_increase FROM e
UNION ALL
SELECT CAST(segment_label AS VARCHAR), {r6s('avg(credit_line) * 1000')}, {r6s('avg(recommended_cli_amount)')},
       {r6s('avg(recommended_cli_amount) / (avg(credit_line) * 1000) * 100')} FROM e GROUP BY segment_label"""


@query("cli_vs_line_ratio", _ratio_sql)
def cli_vs_line_ratio(spark, sf_dir):
    """AGG-19: total increase vs current line overall (sums) and per
    eligible segment (means)."""
    e = scored_view(spark, sf_dir).filter(F.col("segment_label").isin(0, 1))
    line, cli = RP.exact_sum("credit_line"), RP.exact_sum("recommended_cli_amount")
    tot = e.agg(F.lit("all").alias("scope"),
                r6(line * 1000).alias("current_credit"),
                r6(cli).alias("total_cli"),
                r6(cli / (line * 1000) * 100).alias("pct_increase"))
    per = e.groupBy("segment_label").agg(
        r6(F.avg("credit_line") * 1000).alias("current_credit"),
        r6(F.avg("recommended_cli_amount")).alias("total_cli"),
        r6(F.avg("recommended_cli_amount") / (F.avg("credit_line") * 1000) * 100).alias("pct_increase")
    ).select(F.col("segment_label").cast("string").alias("scope"), "current_credit", "total_cli", "pct_increase")
    return tot.unionByName(per)


def _hmg_sql() -> str:
    return OM.user_view_ctes() + f""",
grid AS (SELECT * FROM (VALUES (0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1), (1, 2), (1, 3)) g(income, segment)),
a AS (SELECT is_high_income AS income, segment_label AS segment,
             avg(spend_2024_q4) / ((avg(spend_2024_q1) + avg(spend_2024_q2) + avg(spend_2024_q3)) / 3) AS m
      FROM um GROUP BY 1, 2)
SELECT CAST(g.income AS INTEGER) AS is_high_income, CAST(g.segment AS INTEGER) AS segment_label,
       {r6s('a.m')} AS holiday_multiplier
FROM grid g LEFT JOIN a ON a.income = g.income AND a.segment = g.segment"""


@query("holiday_multiplier_grid", _hmg_sql)
def holiday_multiplier_grid(spark, sf_dir):
    """AGG-20 + FLT-03 + JOIN-14: Q4 mean over the mean of the Q1-Q3 means
    per (income, segment); the 2 x 4 key grid is completed with NULLs."""
    u = user_view(spark, sf_dir)
    a = u.groupBy(F.col("is_high_income").alias("income"), F.col("segment_label").alias("segment")).agg(
        (F.avg("spend_2024_q4") / ((F.avg("spend_2024_q1") + F.avg("spend_2024_q2") + F.avg("spend_2024_q3")) / 3))
        .alias("m"))
    grid = spark.createDataFrame([(i, s) for i in (0, 1) for s in range(4)], "income int, segment int")
    return (grid.join(a, ["income", "segment"], "left")
            .select(F.col("income").alias("is_high_income"), F.col("segment").alias("segment_label"),
                    r6(F.col("m")).alias("holiday_multiplier")))


def _ql_sql() -> str:
    return OM.scored_ctes() + f"""
SELECT {r6s('avg(spend_2024_q1)')} AS avg_q1, {r6s('avg(spend_2024_q2)')} AS avg_q2,
       {r6s('avg(spend_2024_q3)')} AS avg_q3, {r6s('avg(spend_2024_q4)')} AS avg_q4,
       {r6s('avg((spend_2024_q1 + spend_2024_q2 + spend_2024_q3) / 3)')} AS avg_q123,
       {r6s('avg(predicted_q4_spend)')} AS avg_predicted_q4,
       {r6s('(avg(predicted_q4_spend) / avg((spend_2024_q1 + spend_2024_q2 + spend_2024_q3) / 3) - 1) * 100')} AS predicted_q4_lift_pct,
       {r6s('(avg(spend_2024_q4) / avg((spend_2024_q1 + spend_2024_q2 + spend_2024_q3) / 3) - 1) * 100')} AS actual_q4_lift_pct
FROM scored"""


@query("quarter_lift", _ql_sql)
def quarter_lift(spark, sf_dir):
    """AGG-21: quarterly means and the lift of the predicted (and of the
    actual) Q4 spend over the row-wise Q1-Q3 mean."""
    u = scored_view(spark, sf_dir)
    q123 = (F.col("spend_2024_q1") + F.col("spend_2024_q2") + F.col("spend_2024_q3")) / 3
    return u.agg(r6(F.avg("spend_2024_q1")).alias("avg_q1"), r6(F.avg("spend_2024_q2")).alias("avg_q2"),
                 r6(F.avg("spend_2024_q3")).alias("avg_q3"), r6(F.avg("spend_2024_q4")).alias("avg_q4"),
                 r6(F.avg(q123)).alias("avg_q123"),
                 r6(F.avg("predicted_q4_spend")).alias("avg_predicted_q4"),
                 r6((F.avg("predicted_q4_spend") / F.avg(q123) - 1) * 100).alias("predicted_q4_lift_pct"),
                 r6((F.avg("spend_2024_q4") / F.avg(q123) - 1) * 100).alias("actual_q4_lift_pct"))


def _vt_sql() -> str:
    return OM.scored_ctes() + f""",
e AS (SELECT * FROM scored WHERE segment_label IN (0, 1)),
edges AS (SELECT {r6s('q0')} AS e1, {r6s('q1')} AS e2 FROM ({Q.quantile_sql('e', 'total_spend_2024', ['1.0 / 3', '2.0 / 3'])})),
t AS (SELECT e.*, CASE WHEN {r6s('total_spend_2024')} <= e1 THEN 'Low'
                       WHEN {r6s('total_spend_2024')} <= e2 THEN 'Medium' ELSE 'High' END AS value_tier
      FROM e, edges)
SELECT value_tier, {r6s('avg(recommended_cli_amount)')} AS avg_cli, count(*) AS n_users,
       {r6s('count(*) * 100.0 / (SELECT count(*) FROM e)')} AS pct_users
FROM t GROUP BY value_tier"""


@query("value_tiers", _vt_sql)
def value_tiers(spark, sf_dir):
    """AGG-31: spend terciles (right-closed, like ``qcut``) among eligible
    users, then mean increase, count and share per tier."""
    e = scored_view(spark, sf_dir).filter(F.col("segment_label").isin(0, 1))
    return RP.value_tiers(e, "total_spend_2024", "recommended_cli_amount")


def _bi_sql() -> str:
    return OM.scored_ctes() + f""",
e AS (SELECT * FROM scored WHERE segment_label IN (0, 1)),
a AS (SELECT CAST({_dsum('recommended_cli_amount')} AS DOUBLE) AS total_cli, avg(recommended_cli_amount) AS avg_cli,
             count(*) AS eligible_accounts, (SELECT count(*) FROM scored) AS total_accounts,
             avg(risk_probability) AS avg_risk FROM e)
SELECT {r6s('total_cli')} AS total_cli, {r6s('avg_cli')} AS avg_cli, eligible_accounts, total_accounts,
       {r6s('total_cli * 0.25 * 0.18')} AS est_revenue, {r6s('avg_risk * 0.3')} AS est_default_rate,
       {r6s('total_cli * 0.25 * (avg_risk * 0.3)')} AS est_default_loss,
       {r6s('total_cli * 0.25 * 0.18 - total_cli * 0.25 * (avg_risk * 0.3)')} AS net_impact
FROM a"""


@query("business_impact", _bi_sql)
def business_impact(spark, sf_dir):
    """AGG-30: total / mean increase, revenue at 25 % utilisation and 18 %
    interest, default rate 0.3 x mean risk, expected loss and net impact."""
    s = scored_view(spark, sf_dir)
    return RP.business_impact(s)


def _icr_sql() -> str:
    return OM.scored_ctes() + f""",
e AS (SELECT * FROM scored WHERE segment_label IN (0, 1))
SELECT count(*) FILTER (WHERE is_high_income = 1) AS high_income_count,
       {r6s('count(*) FILTER (WHERE is_high_income = 1) * 100.0 / count(*)')} AS high_income_pct,
       {r6s('avg(CASE WHEN is_high_income = 1 THEN recommended_cli_amount END)')} AS high_income_avg_cli,
       {r6s('avg(CASE WHEN is_high_income = 0 THEN recommended_cli_amount END)')} AS regular_avg_cli,
       {r6s('avg(CASE WHEN is_high_income = 1 THEN recommended_cli_amount END) / nullif(avg(CASE WHEN is_high_income = 0 THEN recommended_cli_amount END), 0)')} AS income_cli_ratio
FROM e"""


@query("income_cli_ratio", _icr_sql)
def income_cli_ratio(spark, sf_dir):
    """AGG-33: high-income vs regular mean increase and their ratio."""
    e = scored_view(spark, sf_dir).filter(F.col("segment_label").isin(0, 1))
    hi = F.avg(F.when(F.col("is_high_income") == 1, F.col("recommended_cli_amount")))
    lo = F.avg(F.when(F.col("is_high_income") == 0, F.col("recommended_cli_amount")))
    return e.agg(F.count_if(F.col("is_high_income") == 1).alias("high_income_count"),
                 r6(F.count_if(F.col("is_high_income") == 1) * 100.0 / F.count("*")).alias("high_income_pct"),
                 r6(hi).alias("high_income_avg_cli"), r6(lo).alias("regular_avg_cli"),
                 r6(F.try_divide(hi, F.when(lo != 0, lo))).alias("income_cli_ratio"))


def _hist_sql() -> str:
    return OM.user_view_ctes() + f""",
b AS (SELECT min(risk_probability) AS mn, max(risk_probability) AS mx FROM um),
h AS (SELECT CAST(least(floor((risk_probability - mn) / (mx - mn) * 30), 29) AS BIGINT) AS bin FROM um, b)
SELECT h.bin, count(*) AS n, {r6s('mn + (mx - mn) * h.bin / 30')} AS bin_lo,
       {r6s('mn + (mx - mn) * (h.bin + 1) / 30')} AS bin_hi
FROM h, b GROUP BY h.bin, mn, mx"""


@query("risk_histogram", _hist_sql)
def risk_histogram(spark, sf_dir):
    """AGG-28: 30 equal-width bins of the risk probability over [min, max]."""
    return RP.histogram(user_view(spark, sf_dir), "risk_probability", 30)


def _box_sql() -> str:
    return OM.scored_ctes() + f""",
q AS ({Q.quantile_sql('scored', 'recommended_cli_amount', [0.25, 0.5, 0.75], 'segment_label', ['q1', 'med', 'q3'])})
SELECT q.segment_label, {r6s('q1')} AS q1, {r6s('med')} AS median, {r6s('q3')} AS q3,
       {r6s('min(s.recommended_cli_amount) FILTER (WHERE s.recommended_cli_amount >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
       {r6s('max(s.recommended_cli_amount) FILTER (WHERE s.recommended_cli_amount <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
       count(*) FILTER (WHERE s.recommended_cli_amount < q1 - 1.5 * (q3 - q1)
                           OR s.recommended_cli_amount > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM scored s JOIN q ON q.segment_label = s.segment_label GROUP BY q.segment_label, q1, med, q3"""


@query("cli_boxplot", _box_sql)
def cli_boxplot(spark, sf_dir):
    """AGG-29: box-plot statistics of the increase per segment (quartiles,
    then whiskers inside 1.5 IQR — two passes)."""
    return RP.boxplot(scored_view(spark, sf_dir), "segment_label", "recommended_cli_amount")

"""Core queries: master build, spend pivot, accounts, transactions, FX, fraud."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditlens.functions import rules as R
from creditlens.operators import fx, rollup
from creditlens.plans import oracle_master as OM
from creditlens.plans import sqlparts as Q
from creditlens.plans.registry import query, r6, r6s, user_view
from creditlens.sources import roles
from creditlens.sources.roles import PERIODS, with_roles
from creditlens.sources.tables import Tables

# ------------------------------------------------------------------ master


def _spend_profile_sql() -> str:
    return OM.user_view_ctes() + f"""
SELECT seg AS segment_label, count(*) AS n_users,
       {r6s('avg(credit_line)')} AS avg_credit_line,
       {r6s('avg(utilization_pct)')} AS avg_utilization_pct,
       CAST(round(sum(CAST(total_spend_2024 AS DECIMAL(38,4))), 2) AS DOUBLE) AS total_spend_2024
FROM (SELECT *, {Q.segment_b_sql()} AS seg FROM um) GROUP BY seg"""


@query("user_spend_profile", _spend_profile_sql)
def user_spend_profile(spark, sf_dir):
    """Flagship: master build -> RUL-10 segment -> mean line / utilisation,
    user count and total spend per segment (AGG-18)."""
    u = user_view(spark, sf_dir)
    seg = R.segment_b("utilization_pct", "credit_score", "risk_flag")
    return (u.withColumn("seg", seg).groupBy(F.col("seg").alias("segment_label"))
            .agg(F.count("*").alias("n_users"),
                 r6(F.avg("credit_line")).alias("avg_credit_line"),
                 r6(F.avg("utilization_pct")).alias("avg_utilization_pct"),
                 F.round(F.sum(F.col("total_spend_2024").cast("decimal(38,4)")), 2).cast("double")
                 .alias("total_spend_2024")))


@query("user_master", OM.user_master_sql)
def user_master_q(spark, sf_dir):
    return user_view(spark, sf_dir)


@query("user_rollup", lambda: OM.user_ctes() + "\nSELECT * FROM ufin")
def user_rollup_q(spark, sf_dir):
    """AGG-07 + JOIN-08 + RUL-24 + RUL-03 before imputation."""
    t = Tables(spark, sf_dir)
    return rollup.finish_user(rollup.user_rollup(rollup.account_table(t)), rollup.accounts_per_user(t))


_ACCT_COLS = ["current_account_nbr", "user_id", "is_high_income", "open_date", "card_activation_date",
              "closed_date", "return_check_cnt_total"] + rollup.SPEND_COLS + rollup.COUNT_COLS + [
    "has_fraud", *rollup.FRAUD_TX_COLS, "credit_line", "current_balance", "behavior_score", "credit_score",
    *OM.PH_COLS, "account_age_days", "activation_delay_days", "avg_transaction_size_2024", "is_active_account"]


def _acct_out_sql() -> str:
    cols = []
    for c in _ACCT_COLS:
        if c in ("open_date", "card_activation_date", "closed_date"):
            cols.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c in rollup.SPEND_COLS or c in ("fraud_transaction_sum", "fraud_transaction_max",
                                               "fraud_transaction_min", "credit_line", "current_balance"):
            cols.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            cols.append(c)
    return OM.account_ctes() + f"\nSELECT {', '.join(cols)} FROM acct"


@query("account_features", _acct_out_sql)
def account_features(spark, sf_dir):
    """The account-level merged table (JOIN-01/02/03, AGG-03/04/05/06,
    RUL-02, DAT-07/08, MTH-02, RUL-24)."""
    return account_columns(Tables(spark, sf_dir))


def account_columns(src):
    """The account table of ``Tables`` or ``Sources`` as the query returns it."""
    a = rollup.account_table(src)
    out = []
    for c in _ACCT_COLS:
        dt = a.schema[c].dataType.typeName()
        if c in ("open_date", "card_activation_date", "closed_date"):
            out.append(F.col(c).cast("string").alias(c))
        elif dt == "decimal":
            out.append(F.col(c).cast("double").alias(c))
        else:
            out.append(F.col(c))
    return a.select(*out)


# ---------------------------------------------------------- spend pivots

def _pivot_sql() -> str:
    cols = ", ".join([f"CAST({c} AS DOUBLE) AS {c}" for c in rollup.SPEND_COLS] + rollup.COUNT_COLS)
    return with_roles("domestic_transactions", "foreign_transactions") + f""",
u AS (SELECT *, NULL AS us_equiv_amt FROM domestic_transactions UNION ALL BY NAME SELECT * FROM foreign_transactions),
s AS (SELECT current_account_nbr, transaction_date, transaction_type, {Q.signed_amount_sql()} AS signed_amount FROM u),
p AS ({Q.period_pivot_sql('s')})
SELECT current_account_nbr, {cols} FROM p"""


@query("period_pivot_by_account", _pivot_sql)
def period_pivot_by_account(spark, sf_dir):
    """FLT-02 + DAT-11 + AGG-04 over every account with a transaction, from one
    scan of both kinds (the union by name of two tables is ``union_transactions``)."""
    p = rollup.period_pivot(roles.transactions(Tables(spark, sf_dir)))
    return p.select("current_account_nbr", *[F.col(c).cast("double").alias(c) for c in rollup.SPEND_COLS],
                    *rollup.COUNT_COLS)


def _signed_sql() -> str:
    return with_roles("transactions") + f"""
SELECT current_account_nbr, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_type,
       CAST(transaction_amt AS DOUBLE) AS transaction_amt,
       CAST((CASE WHEN us_equiv_amt IS NULL OR us_equiv_amt = 0 THEN transaction_amt ELSE us_equiv_amt END) AS DOUBLE)
           AS effective_amt,
       CAST({Q.signed_amount_sql()} AS DOUBLE) AS signed_amount,
       CAST(transaction_type = 'SALE' AS INTEGER) AS is_purchase,
       CAST(transaction_type = 'RETURN' AS INTEGER) AS is_return
FROM transactions"""


@query("signed_amounts", _signed_sql)
def signed_amounts(spark, sf_dir):
    """RUL-01 + PRJ-09 per transaction."""
    tx = roles.transactions(Tables(spark, sf_dir))
    return tx.select(
        "current_account_nbr", F.col("transaction_date").cast("string").alias("transaction_date"),
        "transaction_type", F.col("transaction_amt").cast("double").alias("transaction_amt"),
        R.effective_amount("transaction_amt", "us_equiv_amt").cast("double").alias("effective_amt"),
        R.signed_amount("transaction_type", "transaction_amt", "us_equiv_amt").cast("double").alias("signed_amount"),
        (F.col("transaction_type") == "SALE").cast("int").alias("is_purchase"),
        (F.col("transaction_type") == "RETURN").cast("int").alias("is_return"))


# -------------------------------------------------------------- accounts

def _apu_sql() -> str:
    return with_roles("identity_map") + """
SELECT ds_id AS user_id, count(account_nbr_pty) AS n_accounts FROM identity_map
WHERE ds_id IS NOT NULL GROUP BY 1"""


@query("accounts_per_user", _apu_sql)
def accounts_per_user(spark, sf_dir):
    """AGG-01: non-null account count per user."""
    m = roles.identity_map(Tables(spark, sf_dir))
    return (m.filter(F.col("ds_id").isNotNull()).groupBy(F.col("ds_id").alias("user_id"))
            .agg(F.count("account_nbr_pty").alias("n_accounts")))


def _accounts_freq_sql() -> str:
    return with_roles("identity_map") + f""",
apu AS (SELECT ds_id AS user_id, count(account_nbr_pty) AS n_accounts FROM identity_map
        WHERE ds_id IS NOT NULL GROUP BY 1)
SELECT n_accounts, count(*) AS n_users,
       {r6s('count(*) * 100.0 / (SELECT count(*) FROM apu)')} AS pct_users
FROM apu GROUP BY n_accounts"""


@query("accounts_freq", _accounts_freq_sql)
def accounts_freq(spark, sf_dir):
    """AGG-15: frequency of accounts-per-user with share of users (the total
    is a one-row aggregate joined by broadcast, not an unpartitioned window)."""
    apu = accounts_per_user(spark, sf_dir)
    total = apu.select(F.count("*")).scalar()  # scalar subquery
    f = apu.groupBy("n_accounts").agg(F.count("*").alias("n_users"))
    return f.select("n_accounts", "n_users", r6(F.col("n_users") * 100.0 / total).alias("pct_users"))


def _top_sql() -> str:
    return _apu_sql() + " ORDER BY n_accounts DESC, user_id LIMIT 10"


@query("top_users_by_accounts", _top_sql)
def top_users_by_accounts(spark, sf_dir):
    """SRT-01: top 10 users by account count (user id breaks ties)."""
    return accounts_per_user(spark, sf_dir).orderBy(F.desc("n_accounts"), "user_id").limit(10)


def _discrepancy_sql() -> str:
    return OM.user_view_ctes() + f""",
apu AS (SELECT ds_id AS user_id, count(account_nbr_pty) AS n_accounts FROM identity_map
        WHERE ds_id IS NOT NULL GROUP BY 1)
SELECT m.master_max, m.master_mean, r.raw_max, r.raw_mean, m.master_max > r.raw_max AS discrepancy
FROM (SELECT CAST(max(num_accounts) AS BIGINT) AS master_max, {r6s('avg(num_accounts)')} AS master_mean FROM um) m,
     (SELECT max(n_accounts) AS raw_max, {r6s('avg(n_accounts)')} AS raw_mean FROM apu) r"""


@query("account_count_discrepancy", _discrepancy_sql)
def account_count_discrepancy(spark, sf_dir):
    """AGG-32: master vs raw mapping account counts (two one-row aggregates)."""
    r = accounts_per_user(spark, sf_dir)
    u = user_view(spark, sf_dir).agg(F.max("num_accounts").cast("long").alias("master_max"),
                                     r6(F.avg("num_accounts")).alias("master_mean"))
    return u.select("*", r.select(F.max("n_accounts")).scalar().alias("raw_max"),
                    r.select(r6(F.avg("n_accounts"))).scalar().alias("raw_mean")) \
            .withColumn("discrepancy", F.col("master_max") > F.col("raw_max"))


# ------------------------------------------------------------------- FX

@query("fx_asof_convert", fx.asof_convert_sql)
def fx_asof_convert(spark, sf_dir):
    """JOIN-10 + JOIN-11: as-of rate lookup and conversion."""
    return fx.asof_convert(Tables(spark, sf_dir))


@query("fx_keyed_amount", fx.keyed_amount_sql)
def fx_keyed_amount(spark, sf_dir):
    """JOIN-04: composite-key (account, date, amount) lookup of the USD amount."""
    return fx.keyed_amount(Tables(spark, sf_dir))


@query("business_days_between", fx.business_days_sql)
def business_days_between(spark, sf_dir):
    """DAT-10: US business days between each order date and its first ship."""
    return fx.business_days_between(Tables(spark, sf_dir))


# ---------------------------------------------------------- payment history

def _ph_sql() -> str:
    ph = ",\n".join(Q.payment_history_sql(f"payment_hist_{p}_mths", f"payment_hist_{p}_") for p in ("1_12", "13_24"))
    return with_roles("account_dim") + f"""
SELECT current_account_nbr, payment_hist_1_12_mths, payment_hist_13_24_mths, {ph} FROM account_dim"""


@query("payment_history_features", _ph_sql)
def payment_history_features(spark, sf_dir):
    """RUL-02 + STR-01..03 + PRJ-08."""
    a = roles.account_dim(Tables(spark, sf_dir))
    cols = []
    for p in ("1_12", "13_24"):
        cols += R.payment_history_columns(f"payment_hist_{p}_mths", f"payment_hist_{p}_")
    return a.select("current_account_nbr", "payment_hist_1_12_mths", "payment_hist_13_24_mths", *cols)


# ----------------------------------------------------------------- fraud

def _ftba_sql() -> str:
    return with_roles("fraud_claim_tran") + """
SELECT current_account_nbr, count(transaction_am) AS fraud_transaction_count,
       CAST(sum(transaction_am) AS DOUBLE) AS fraud_transaction_sum,
       CAST(sum(transaction_am) AS DOUBLE) / count(transaction_am) AS fraud_transaction_avg,
       CAST(max(transaction_am) AS DOUBLE) AS fraud_transaction_max,
       CAST(min(transaction_am) AS DOUBLE) AS fraud_transaction_min,
       count(DISTINCT case_id) AS fraud_case_count
FROM fraud_claim_tran GROUP BY 1"""


@query("fraud_tran_by_account", _ftba_sql)
def fraud_tran_by_account(spark, sf_dir):
    """AGG-05 + PRJ-07."""
    f = rollup.fraud_tran_by_account(roles.fraud_claim_tran(Tables(spark, sf_dir)))
    return f.withColumns({c: F.col(c).cast("double") for c in
                          ("fraud_transaction_sum", "fraud_transaction_max", "fraud_transaction_min")})


def _semi_sql() -> str:
    return with_roles("account_dim", "fraud_claim_case") + """
SELECT a.current_account_nbr,
       CAST(EXISTS (SELECT 1 FROM fraud_claim_case f WHERE f.current_account_nbr = a.current_account_nbr) AS INTEGER)
           AS has_fraud
FROM account_dim a"""


@query("fraud_flag_semi", _semi_sql)
def fraud_flag_semi(spark, sf_dir):
    """JOIN-09: account appears in the fraud cases -> 1 else 0 (left join to
    the distinct fraud accounts, so accounts are not multiplied)."""
    t = Tables(spark, sf_dir)
    fa = roles.fraud_claim_case(t).select("current_account_nbr").distinct().withColumn("_f", F.lit(1))
    a = roles.account_dim(t).select("current_account_nbr")
    return (a.join(fa, "current_account_nbr", "left")
            .select("current_account_nbr", F.coalesce("_f", F.lit(0)).cast("int").alias("has_fraud")))


def _fraud_cmp_sql() -> str:
    return with_roles("account_dim", "identity_map", "fraud_claim_case", "credit_snapshot") + f""",
m AS (SELECT a.current_account_nbr,
             CAST(EXISTS (SELECT 1 FROM fraud_claim_case f WHERE f.current_account_nbr = a.current_account_nbr)
                  AS INTEGER) AS has_fraud,
             CAST(s.cu_crd_line AS DOUBLE) AS credit_line, CAST(s.cu_cur_balance AS DOUBLE) AS current_balance,
             s.cu_bhv_scr AS behavior_score, s.cu_crd_bureau_scr AS credit_score,
             DATE '{PERIODS.ref_date}' - a.open_date AS account_age_days
      FROM account_dim a JOIN identity_map i ON i.account_nbr_pty = a.current_account_nbr
      LEFT JOIN credit_snapshot s ON s.cu_account_nbr = a.current_account_nbr)
SELECT has_fraud, count(*) AS n_accounts,
       {r6s('count(*) * 100.0 / (SELECT count(*) FROM m)')} AS pct_accounts,
       {r6s('avg(credit_line)')} AS avg_credit_line, {r6s('avg(current_balance)')} AS avg_current_balance,
       {r6s('avg(behavior_score)')} AS avg_behavior_score, {r6s('avg(credit_score)')} AS avg_credit_score,
       {r6s('avg(account_age_days)')} AS avg_account_age_days,
       {r6s('avg(CASE WHEN credit_line > 0 THEN current_balance / credit_line * 100.0 END)')} AS avg_utilization_pct
FROM m GROUP BY has_fraud"""


@query("fraud_comparison", _fraud_cmp_sql)
def fraud_comparison(spark, sf_dir):
    """AGG-25: fraud vs non-fraud accounts — counts, shares, five means and
    mean utilisation."""
    t = Tables(spark, sf_dir)
    fa = roles.fraud_claim_case(t).select("current_account_nbr").distinct().withColumn("_f", F.lit(1))
    idm = roles.identity_map(t).select(F.col("account_nbr_pty").alias("current_account_nbr"))
    snap = roles.credit_snapshot(t).withColumnsRenamed(rollup.SNAPSHOT_RENAME)
    m = (roles.account_dim(t).select("current_account_nbr", "open_date")
         .join(idm, "current_account_nbr").join(fa, "current_account_nbr", "left")
         .join(snap, "current_account_nbr", "left")
         .select(F.coalesce("_f", F.lit(0)).cast("int").alias("has_fraud"),
                 F.col("credit_line").cast("double").alias("credit_line"),
                 F.col("current_balance").cast("double").alias("current_balance"),
                 "behavior_score", "credit_score",
                 F.datediff(F.lit(PERIODS.ref_date).cast("date"), "open_date").alias("account_age_days")))
    g = m.groupBy("has_fraud").agg(
        F.count("*").alias("n_accounts"),
        r6(F.avg("credit_line")).alias("avg_credit_line"),
        r6(F.avg("current_balance")).alias("avg_current_balance"),
        r6(F.avg("behavior_score")).alias("avg_behavior_score"),
        r6(F.avg("credit_score")).alias("avg_credit_score"),
        r6(F.avg("account_age_days")).alias("avg_account_age_days"),
        r6(F.avg(R.guarded_pct("current_balance", "credit_line"))).alias("avg_utilization_pct"))
    total = F.sum("n_accounts").over(Window.partitionBy())  # two rows
    return g.withColumn("pct_accounts", r6(F.col("n_accounts") * 100.0 / total))


def _net_sql() -> str:
    return with_roles("fraud_claim_case") + """
SELECT current_account_nbr, CAST(sum(net_fraud_amt) AS DOUBLE) AS net_fraud_amt,
       CAST(sum(gross_fraud_amt) AS DOUBLE) AS gross_fraud_amt, count(*) AS n_cases
FROM fraud_claim_case GROUP BY 1"""


@query("net_fraud_by_account", _net_sql)
def net_fraud_by_account(spark, sf_dir):
    """AGG-27: net (and gross) fraud amount per account."""
    c = roles.fraud_claim_case(Tables(spark, sf_dir))
    return c.groupBy("current_account_nbr").agg(
        F.sum("net_fraud_amt").cast("double").alias("net_fraud_amt"),
        F.sum("gross_fraud_amt").cast("double").alias("gross_fraud_amt"),
        F.count("*").alias("n_cases"))


def _gsize_sql() -> str:
    return with_roles("fraud_claim_tran") + f"""
SELECT {r6s('avg(n)')} AS mean_tx_per_account, CAST(sum(s) AS DOUBLE) AS total_fraud_amount,
       {r6s('CAST(sum(s) AS DOUBLE) / sum(c)')} AS avg_fraud_amount, CAST(max(mx) AS DOUBLE) AS max_fraud_amount
FROM (SELECT current_account_nbr, count(*) AS n, sum(transaction_am) AS s, count(transaction_am) AS c,
             max(transaction_am) AS mx FROM fraud_claim_tran GROUP BY 1)"""


@query("fraud_tx_mean_group_size", _gsize_sql)
def fraud_tx_mean_group_size(spark, sf_dir):
    """AGG-12 + AGG-13: mean transactions per fraud account (two-level
    aggregate) with total / mean / max fraud amount."""
    ft = roles.fraud_claim_tran(Tables(spark, sf_dir))
    per = ft.groupBy("current_account_nbr").agg(F.count("*").alias("n"), F.sum("transaction_am").alias("s"),
                                                F.count("transaction_am").alias("c"),
                                                F.max("transaction_am").alias("mx"))
    return per.agg(r6(F.avg("n")).alias("mean_tx_per_account"),
                   F.sum("s").cast("double").alias("total_fraud_amount"),
                   r6(F.sum("s").cast("double") / F.sum("c")).alias("avg_fraud_amount"),
                   F.max("mx").cast("double").alias("max_fraud_amount"))


def _apu_summary_sql() -> str:
    return with_roles("identity_map") + f""",
apu AS (SELECT ds_id AS user_id, count(account_nbr_pty) AS n_accounts FROM identity_map
        WHERE ds_id IS NOT NULL GROUP BY 1)
SELECT count(*) AS total_users, (SELECT count(*) FROM identity_map) AS total_accounts,
       {r6s('avg(n_accounts)')} AS mean_accounts,
       {r6s(Q.quantile_sql('apu', 'n_accounts', [0.5]).replace('SELECT ', 'SELECT q0 FROM (SELECT ', 1) + ')')} AS median_accounts,
       min(n_accounts) AS min_accounts, max(n_accounts) AS max_accounts
FROM apu"""


@query("accounts_summary", _apu_summary_sql)
def accounts_summary(spark, sf_dir):
    """AGG-13: users, accounts, mean / median / min / max accounts per user."""
    from creditlens.operators.reports import quantile_table
    apu = accounts_per_user(spark, sf_dir)
    total = roles.identity_map(Tables(spark, sf_dir)).select(F.count("*")).scalar()
    med = quantile_table(apu, "n_accounts", [0.5], names=["m"]).select("m").scalar()
    return apu.agg(F.count("*").alias("total_users"), r6(F.avg("n_accounts")).alias("mean_accounts"),
                   r6(med).alias("median_accounts"),
                   F.min("n_accounts").alias("min_accounts"), F.max("n_accounts").alias("max_accounts")) \
              .withColumn("total_accounts", total)

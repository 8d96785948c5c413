"""Operator-level queries: cleaning recipes, projections, filters, joins,
set/aggregate utilities, sorting, dates, arithmetic and entity summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlens.functions import rules as R
from creditlens.operators import clean as C
from creditlens.operators import rollup
from creditlens.plans import oracle_master as OM
from creditlens.plans.registry import query, r6, r6s, scored_view, user_view
from creditlens.sources import roles
from creditlens.sources.roles import PERIODS, with_roles
from creditlens.sources.tables import Tables

# ------------------------------------------------------------- cleaning

_ACC_OUT = ["current_account_nbr", "client_id", "open_date", "card_activation_date", "closed_date",
            "is_high_income", "ebill_ind", "pscc_ind", "external_status_reason_code", "ext_status_reason_cd_desc",
            "payment_hist_1_12_mths", "payment_hist_13_24_mths"]


def _clean_acc_sql() -> str:
    return with_roles("account_dim") + """
SELECT current_account_nbr, client_id, CAST(open_date AS VARCHAR) AS open_date,
       CAST(card_activation_date AS VARCHAR) AS card_activation_date, CAST(closed_date AS VARCHAR) AS closed_date,
       CASE WHEN hi IS NULL THEN true ELSE CAST(hi AS DOUBLE) <> 0 END AS is_high_income,
       coalesce(CASE WHEN ebill_ind = '\\\\\\""' THEN ' ' ELSE ebill_ind END, ' ') AS ebill_ind,
       CASE WHEN pscc_ind IS NULL THEN true ELSE CAST(pscc_ind AS DOUBLE) <> 0 END AS pscc_ind,
       external_status_reason_code,
       CASE WHEN ext_status_reason_cd_desc IS NULL AND coalesce(external_status_reason_code = 0, false) THEN 'Normal'
            WHEN ext_status_reason_cd_desc IS NULL AND NOT coalesce(external_status_reason_code = 0, false) THEN 'Other'
            ELSE CASE WHEN ext_status_reason_cd_desc = '\\\\\\""' THEN ' ' ELSE ext_status_reason_cd_desc END END
           AS ext_status_reason_cd_desc,
       payment_hist_1_12_mths, payment_hist_13_24_mths
FROM (SELECT *, CASE WHEN employee_code IS NULL OR employee_code = 'Y' THEN 0 WHEN employee_code = 'H' THEN 1 END AS hi
      FROM account_dim)"""


@query("clean_account_dim", _clean_acc_sql)
def clean_account_dim(spark, sf_dir):
    """RUL-25 account recipe: PRJ-02 drop, PRJ-01 rename, PRJ-15 income map,
    PRJ-17 cell replacement, PRJ-18 fill, PRJ-10 status fill, PRJ-13 bool casts."""
    a = C.clean_account_dim(roles.account_dim(Tables(spark, sf_dir)))
    return a.select(*[F.col(c).cast("string").alias(c) if c.endswith("_date") else F.col(c) for c in _ACC_OUT])


def _clean_stmt_sql() -> str:
    return with_roles("statement_fact") + """
SELECT current_account_nbr, user_id, CAST(billing_cycle_date AS VARCHAR) AS billing_cycle_date,
       CAST(prev_balance AS DOUBLE) AS prev_balance, return_check_cnt_total,
       CASE WHEN return_check_cnt_last_mth = 99 THEN 0 ELSE return_check_cnt_last_mth END AS return_check_cnt_last_mth
FROM statement_fact"""


@query("clean_statement_fact", _clean_stmt_sql)
def clean_statement_fact(spark, sf_dir):
    """RUL-25 statement recipe with PRJ-16 (99 -> 0)."""
    s = C.clean_statement_fact(roles.statement_fact(Tables(spark, sf_dir)))
    return s.select("current_account_nbr", "user_id", F.col("billing_cycle_date").cast("string").alias("billing_cycle_date"),
                    F.col("prev_balance").cast("double").alias("prev_balance"), "return_check_cnt_total",
                    "return_check_cnt_last_mth")


def _clean_idm_sql() -> str:
    return with_roles("identity_map") + """
SELECT account_nbr_pty, ds_id, CAST(open_date AS VARCHAR) AS open_date, coalesce(closed_date, 'Open') AS closed_date
FROM identity_map"""


@query("clean_identity_map", _clean_idm_sql)
def clean_identity_map(spark, sf_dir):
    """RUL-25 identity recipe: closed date filled with 'Open'."""
    m = C.clean_identity_map(roles.identity_map(Tables(spark, sf_dir)))
    return m.select("account_nbr_pty", "ds_id", F.col("open_date").cast("string").alias("open_date"), "closed_date")


def _clean_tx_sql() -> str:
    return with_roles("transaction_fact_raw") + """
SELECT current_account_nbr, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_type,
       CAST(transaction_amt AS DOUBLE) AS transaction_amt,
       CAST(CAST(try_strptime(posting_date, '%Y-%m-%d') AS DATE) AS VARCHAR) AS posting_date,
       CAST(CAST(try_strptime(coalesce(adj_orgn_tran_dt, 'No Date'), '%Y-%m-%d') AS DATE) AS VARCHAR) AS adj_orgn_tran_dt,
       coalesce(invoice_nbr, 'No Invoice Number') AS invoice_nbr,
       coalesce(fcr_amount, 0) AS fcr_amount, coalesce(fcr_rate_of_exchange, 0) AS fcr_rate_of_exchange,
       coalesce(product_qty, 0) AS product_qty
FROM transaction_fact_raw"""


@query("clean_transaction_fact", _clean_tx_sql)
def clean_transaction_fact(spark, sf_dir):
    """RUL-25 transaction recipe: zero fill, placeholder texts, lenient
    date parsing ('No Date' -> NULL)."""
    raw = roles.transaction_fact_raw(Tables(spark, sf_dir)).fillna({"adj_orgn_tran_dt": "No Date"})
    tx = C.clean_transactions(raw)
    return tx.select("current_account_nbr", F.col("transaction_date").cast("string").alias("transaction_date"),
                     "transaction_type", F.col("transaction_amt").cast("double").alias("transaction_amt"),
                     F.col("posting_date").cast("string").alias("posting_date"),
                     F.col("adj_orgn_tran_dt").cast("string").alias("adj_orgn_tran_dt"),
                     "invoice_nbr", "fcr_amount", "fcr_rate_of_exchange", "product_qty")


def _clean_fx_sql() -> str:
    return with_roles("foreign_transactions") + """
SELECT current_account_nbr, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_type,
       CAST(transaction_amt AS DOUBLE) AS transaction_amt, CAST(us_equiv_amt AS DOUBLE) AS us_equiv_amt
FROM foreign_transactions"""


@query("clean_foreign_transactions", _clean_fx_sql)
def clean_foreign_transactions(spark, sf_dir):
    """RUL-25 foreign-transaction recipe (conversion itself: fx_asof_convert)."""
    tx = C.clean_transactions(roles.foreign_transactions(Tables(spark, sf_dir)))
    return tx.select("current_account_nbr", F.col("transaction_date").cast("string").alias("transaction_date"),
                     "transaction_type", F.col("transaction_amt").cast("double").alias("transaction_amt"),
                     F.col("us_equiv_amt").cast("double").alias("us_equiv_amt"))


def _clean_case_sql() -> str:
    return with_roles("fraud_claim_case") + """
SELECT case_id, current_account_nbr, CAST(reported_date AS VARCHAR) AS reported_date,
       CAST(open_date AS VARCHAR) AS open_date, CAST(reopen_date AS VARCHAR) AS reopen_date,
       CAST(close_date AS VARCHAR) AS close_date, CAST(gross_fraud_amt AS DOUBLE) AS gross_fraud_amt,
       CAST(net_fraud_amt AS DOUBLE) AS net_fraud_amt
FROM fraud_claim_case"""


@query("clean_fraud_claim_case", _clean_case_sql)
def clean_fraud_claim_case(spark, sf_dir):
    """RUL-25 fraud-case recipe (typed dates, missing reopen/close stay NULL)."""
    c = C.clean_fraud_case(roles.fraud_claim_case(Tables(spark, sf_dir)))
    return c.select("case_id", "current_account_nbr",
                    *[F.col(d).cast("string").alias(d) for d in ("reported_date", "open_date", "reopen_date", "close_date")],
                    F.col("gross_fraud_amt").cast("double").alias("gross_fraud_amt"),
                    F.col("net_fraud_amt").cast("double").alias("net_fraud_amt"))


def _clean_ftran_sql() -> str:
    return with_roles("fraud_claim_tran") + """
SELECT case_id, current_account_nbr, CAST(transaction_am AS DOUBLE) AS transaction_am,
       CAST(transaction_dt AS VARCHAR) AS transaction_dt FROM fraud_claim_tran"""


@query("clean_fraud_claim_tran", _clean_ftran_sql)
def clean_fraud_claim_tran(spark, sf_dir):
    """RUL-25 fraud-transaction recipe."""
    f = roles.fraud_claim_tran(Tables(spark, sf_dir))
    return f.select("case_id", "current_account_nbr", F.col("transaction_am").cast("double").alias("transaction_am"),
                    F.col("transaction_dt").cast("string").alias("transaction_dt"))


def _clean_snap_sql() -> str:
    return with_roles("credit_snapshot") + """
SELECT cu_account_nbr, CAST(cu_crd_line AS DOUBLE) AS cu_crd_line, CAST(cu_cur_balance AS DOUBLE) AS cu_cur_balance,
       cu_bhv_scr, cu_crd_bureau_scr, CAST(cu_next_crd_line_rev_date AS VARCHAR) AS cu_next_crd_line_rev_date,
       CAST(cu_processing_date AS VARCHAR) AS cu_processing_date
FROM credit_snapshot"""


@query("clean_credit_snapshot", _clean_snap_sql)
def clean_credit_snapshot(spark, sf_dir):
    """RUL-25 credit-line snapshot recipe: PRJ-02 drop of the random number."""
    s = C.clean_credit_snapshot(roles.credit_snapshot(Tables(spark, sf_dir)))
    return s.select("cu_account_nbr", F.col("cu_crd_line").cast("double").alias("cu_crd_line"),
                    F.col("cu_cur_balance").cast("double").alias("cu_cur_balance"), "cu_bhv_scr", "cu_crd_bureau_scr",
                    F.col("cu_next_crd_line_rev_date").cast("string").alias("cu_next_crd_line_rev_date"),
                    F.col("cu_processing_date").cast("string").alias("cu_processing_date"))


# ------------------------------------------------------------ projections

def _rdp_sql() -> str:
    return with_roles("credit_snapshot", "identity_map") + """
SELECT s.cu_account_nbr AS current_account_nbr, i.ds_id AS user_id, CAST(s.cu_crd_line AS DOUBLE) AS credit_line,
       CAST(s.cu_cur_balance AS DOUBLE) AS current_balance, s.cu_bhv_scr AS behavior_score,
       s.cu_crd_bureau_scr AS credit_score
FROM credit_snapshot s JOIN identity_map i ON i.account_nbr_pty = s.cu_account_nbr"""


@query("rename_drop_prune", _rdp_sql)
def rename_drop_prune(spark, sf_dir):
    """PRJ-01 rename map, PRJ-02 drop, PRJ-03 pruning before a join."""
    t = Tables(spark, sf_dir)
    s = (roles.credit_snapshot(t).withColumnsRenamed(rollup.SNAPSHOT_RENAME)
         .drop("cu_rnd_nbr", "cu_next_crd_line_rev_date", "cu_processing_date"))
    m = roles.identity_map(t).select(F.col("account_nbr_pty").alias("current_account_nbr"),
                                     F.col("ds_id").alias("user_id"))
    j = s.join(m, "current_account_nbr")
    return j.select("current_account_nbr", "user_id", F.col("credit_line").cast("double").alias("credit_line"),
                    F.col("current_balance").cast("double").alias("current_balance"), "behavior_score", "credit_score")


def _masked_sql() -> str:
    return OM.user_view_ctes() + """
SELECT user_id, CAST(0.05 AS DOUBLE) AS economic_factor, 1 AS is_active_default,
       CASE WHEN utilization_pct > 90 THEN 'critical' WHEN utilization_pct > 70 THEN 'high'
            WHEN utilization_pct > 30 THEN 'moderate' ELSE 'low' END AS util_band
FROM um"""


@query("default_and_masked_columns", _masked_sql)
def default_and_masked_columns(spark, sf_dir):
    """PRJ-12 constant columns + PRJ-11 masked assignments in sequence
    (low; > 30 moderate; > 70 high; > 90 critical: later masks win)."""
    u = user_view(spark, sf_dir)
    util = F.col("utilization_pct")
    band = (F.when(util > 90, "critical").when(util > 70, "high").when(util > 30, "moderate").otherwise("low"))
    return u.select("user_id", F.lit(0.05).alias("economic_factor"), F.lit(1).alias("is_active_default"),
                    band.alias("util_band"))


def _cast_sql() -> str:
    return with_roles("account_dim") + """
SELECT current_account_nbr, CASE WHEN pscc_ind IS NULL THEN true ELSE CAST(pscc_ind AS DOUBLE) <> 0 END AS pscc_bool,
       CAST(coalesce(pscc_ind, 0) AS INTEGER) AS pscc_int, CAST(external_status_reason_code AS BIGINT) AS status_code
FROM account_dim"""


@query("cast_flags", _cast_sql)
def cast_flags(spark, sf_dir):
    """PRJ-13: bool cast with missing -> True (pandas semantics), fill +
    int cast, widening cast."""
    a = roles.account_dim(Tables(spark, sf_dir))
    return a.select("current_account_nbr", C.as_bool("pscc_ind").alias("pscc_bool"),
                    F.coalesce("pscc_ind", F.lit(0)).cast("int").alias("pscc_int"),
                    F.col("external_status_reason_code").cast("long").alias("status_code"))


def _income_sql() -> str:
    return with_roles("account_dim") + """
SELECT current_account_nbr, employee_code,
       CASE WHEN employee_code IS NULL OR employee_code = 'Y' THEN 0 WHEN employee_code = 'H' THEN 1 END AS is_high_income
FROM account_dim"""


@query("high_income_from_code", _income_sql)
def high_income_from_code(spark, sf_dir):
    """PRJ-15: NULL / 'Y' -> 0, 'H' -> 1."""
    a = roles.account_dim(Tables(spark, sf_dir))
    return a.select("current_account_nbr", "employee_code", R.income_from_code("employee_code").alias("is_high_income"))


def _cell_sql() -> str:
    return with_roles("account_dim") + """
SELECT current_account_nbr,
       CASE WHEN ext_status_reason_cd_desc = 'Closed by request' THEN ' ' ELSE ext_status_reason_cd_desc END
           AS ext_status_reason_cd_desc,
       CASE WHEN ebill_ind = 'Closed by request' THEN ' ' ELSE ebill_ind END AS ebill_ind
FROM account_dim"""


@query("cell_replace", _cell_sql)
def cell_replace(spark, sf_dir):
    """PRJ-17: whole-cell literal replacement across string columns."""
    a = roles.account_dim(Tables(spark, sf_dir)).select("current_account_nbr", "ext_status_reason_cd_desc", "ebill_ind")
    return C.replace_cells(a, "Closed by request", " ")


ALLOW = ["avg_monthly_spend_2024", "total_spend_2024", "spend_2024_q1", "spend_2024_q2", "spend_2024_q3",
         "utilization_pct", "credit_score", "credit_line", "payment_hist_1_12_delinquency_count",
         "current_balance", "is_high_income", "q4_adjustment_factor"]


def _allow_sql() -> str:
    present = [c for c in ALLOW if c != "q4_adjustment_factor"]
    um_cols = list(OM.USER_NUMERIC) + ["delinquency_12mo", "delinquency_24mo", "risk_flag", "segment_label",
                                       "risk_probability"]
    zero = ", ".join(c for c in um_cols if (c.startswith(("total_", "count_", "num_"))
                                             or c.endswith(("_count", "_flag"))) and c not in present)
    return OM.user_view_ctes() + f"\nSELECT user_id, {', '.join(present)}, {zero} FROM um"


@query("allowlist_projection", _allow_sql)
def allowlist_projection(spark, sf_dir):
    """PRJ-06 feature allow-list (keep listed columns that exist) + STR-04
    name-pattern selection (count-like names by prefix / suffix)."""
    u = user_view(spark, sf_dir)
    keep = [c for c in ALLOW if c in u.columns]
    zero = [c for c in u.columns if c.startswith(("total_", "count_", "num_")) or c.endswith(("_count", "_flag"))]
    return u.select("user_id", *keep, *[c for c in zero if c not in keep])


# ----------------------------------------------------------------- filters

def _f_sql(where: str, cols: str = "user_id") -> str:
    return OM.user_view_ctes() + f"\nSELECT {cols} FROM um WHERE {where}"


@query("filter_equal_flag", lambda: _f_sql("is_high_income = 1", "user_id, credit_line"))
def filter_equal_flag(spark, sf_dir):
    """FLT-01: equality filter."""
    return user_view(spark, sf_dir).filter(F.col("is_high_income") == 1).select("user_id", "credit_line")


@query("filter_two_keys", lambda: _f_sql("is_high_income = 1 AND segment_label = 0", "user_id, segment_label"))
def filter_two_keys(spark, sf_dir):
    """FLT-03: conjunctive filter on two keys."""
    u = user_view(spark, sf_dir)
    return u.filter((F.col("is_high_income") == 1) & (F.col("segment_label") == 0)).select("user_id", "segment_label")


@query("filter_any_delinquent", lambda: _f_sql(
    "payment_hist_1_12_delinquency_count >= 1 OR payment_hist_13_24_delinquency_count >= 1"))
def filter_any_delinquent(spark, sf_dir):
    """FLT-04: disjunctive filter."""
    u = user_view(spark, sf_dir)
    return u.filter((F.col("payment_hist_1_12_delinquency_count") >= 1)
                    | (F.col("payment_hist_13_24_delinquency_count") >= 1)).select("user_id")


@query("filter_eligible", lambda: _f_sql("segment_label IN (0, 1)", "user_id, segment_label"))
def filter_eligible(spark, sf_dir):
    """FLT-05: set membership."""
    u = user_view(spark, sf_dir)
    return u.filter(F.col("segment_label").isin(0, 1)).select("user_id", "segment_label")


def _nulls_sql() -> str:
    return with_roles("account_dim") + """
SELECT current_account_nbr, CAST(open_date AS VARCHAR) AS open_date FROM account_dim
WHERE card_activation_date IS NULL AND open_date IS NOT NULL"""


@query("filter_nulls", _nulls_sql)
def filter_nulls(spark, sf_dir):
    """FLT-07: missing / present value filters (accounts never activated)."""
    a = roles.account_dim(Tables(spark, sf_dir))
    return (a.filter(F.col("card_activation_date").isNull() & F.col("open_date").isNotNull())
            .select("current_account_nbr", F.col("open_date").cast("string").alias("open_date")))


@query("filter_many_accounts", lambda: _f_sql("num_accounts > 3", "user_id, num_accounts, credit_line, current_balance"))
def filter_many_accounts(spark, sf_dir):
    """FLT-08: users with more than three accounts."""
    u = user_view(spark, sf_dir)
    return u.filter(F.col("num_accounts") > 3).select("user_id", "num_accounts", "credit_line", "current_balance")


def _neg_sql() -> str:
    return OM.user_view_ctes() + """
SELECT user_id FROM um WHERE NOT coalesce(utilization_pct <= 30, false) AND NOT coalesce(risk_flag = 1, false)"""


@query("filter_negated_mask", _neg_sql)
def filter_negated_mask(spark, sf_dir):
    """FLT-11: negated masks with NaN-as-False semantics."""
    u = user_view(spark, sf_dir)
    return u.filter(R.is_not(F.col("utilization_pct") <= 30) & R.is_not(F.col("risk_flag") == 1)).select("user_id")


# ------------------------------------------------------------------ joins

def _fanout_sql() -> str:
    return with_roles("account_dim", "credit_snapshot") + """,
snap AS (SELECT * FROM credit_snapshot UNION ALL
         SELECT * REPLACE (cu_processing_date + 30 AS cu_processing_date, cu_cur_balance * 2 AS cu_cur_balance)
         FROM credit_snapshot WHERE cu_bhv_scr % 2 = 0)
SELECT a.current_account_nbr, count(s.cu_account_nbr) AS snapshot_rows,
       CAST(sum(s.cu_cur_balance) AS DOUBLE) AS balance_fanout_sum,
       CAST(arg_max(s.cu_cur_balance, s.cu_processing_date) AS DOUBLE) AS balance_latest
FROM account_dim a LEFT JOIN snap s ON s.cu_account_nbr = a.current_account_nbr GROUP BY 1"""


@query("snapshot_fanout_join", _fanout_sql)
def snapshot_fanout_join(spark, sf_dir):
    """JOIN-03: left join to a snapshot table without pre-aggregation (rows
    multiply, then sum) next to the ``latest`` dedupe option (max_by on the
    processing date).  Half the accounts get a second snapshot row."""
    t = Tables(spark, sf_dir)
    s = roles.credit_snapshot(t)
    extra = (s.filter(F.col("cu_bhv_scr") % 2 == 0)
             .withColumn("cu_processing_date", F.date_add("cu_processing_date", 30))
             .withColumn("cu_cur_balance", F.col("cu_cur_balance") * 2))
    snap = s.unionByName(extra.select(*s.columns))
    a = roles.account_dim(t).select("current_account_nbr")
    j = a.join(snap, a.current_account_nbr == snap.cu_account_nbr, "left")
    return j.groupBy("current_account_nbr").agg(
        F.count("cu_account_nbr").alias("snapshot_rows"),
        F.sum("cu_cur_balance").cast("double").alias("balance_fanout_sum"),
        F.max_by("cu_cur_balance", "cu_processing_date").cast("double").alias("balance_latest"))


def _overlay_sql() -> str:
    return OM.scored_ctes() + """
SELECT user_id, CASE WHEN segment_label IN (0, 1) THEN credit_line * 1000 * max_cli_percentage ELSE 0.0 END
    AS cli_overlay FROM scored"""


@query("eligible_overlay", _overlay_sql)
def eligible_overlay(spark, sf_dir):
    """JOIN-13: a subset's result written back to the full table as a
    conditional column (no join)."""
    s = scored_view(spark, sf_dir)
    return s.select("user_id", F.when(F.col("segment_label").isin(0, 1),
                                      F.col("credit_line") * 1000 * F.col("max_cli_percentage"))
                    .otherwise(F.lit(0.0)).alias("cli_overlay"))


def _anti_sql() -> str:
    return OM.user_view_ctes() + """,
d AS (SELECT DISTINCT user_id FROM um
      WHERE payment_hist_1_12_delinquency_count >= 1 OR payment_hist_13_24_delinquency_count >= 1)
SELECT user_id, credit_line FROM um WHERE user_id NOT IN (SELECT user_id FROM d)"""


@query("delinquent_anti", _anti_sql)
def delinquent_anti(spark, sf_dir):
    """JOIN-12: users not in the delinquent-id list (left anti join)."""
    u = user_view(spark, sf_dir)
    d = u.filter((F.col("payment_hist_1_12_delinquency_count") >= 1)
                 | (F.col("payment_hist_13_24_delinquency_count") >= 1)).select("user_id").distinct()
    return u.join(d, "user_id", "left_anti").select("user_id", "credit_line")


# ------------------------------------------------------- aggregates, sets

def _single_sql() -> str:
    return with_roles("transactions") + """
SELECT current_account_nbr FROM transactions GROUP BY 1 HAVING count(*) = 1"""


@query("singleton_keys", _single_sql)
def singleton_keys(spark, sf_dir):
    """FLT-09: keys that occur exactly once (group-size HAVING)."""
    tx = roles.transactions(Tables(spark, sf_dir))
    return tx.groupBy("current_account_nbr").agg(F.count("*").alias("n")).filter("n = 1").select("current_account_nbr")


def _scs_sql() -> str:
    return with_roles("statement_fact") + """
SELECT current_account_nbr, CAST(sum(return_check_cnt_total) AS BIGINT) AS return_check_cnt_total,
       count(return_check_cnt_last_mth) AS statement_count
FROM statement_fact GROUP BY 1"""


@query("statement_check_sum", _scs_sql)
def statement_check_sum(spark, sf_dir):
    """AGG-03: sum per account, with the count form used when the measure
    column is absent (chosen on the schema)."""
    s = roles.statement_fact(Tables(spark, sf_dir))
    m = (F.sum("return_check_cnt_total") if "return_check_cnt_total" in s.columns
         else F.count("current_account_nbr"))
    return s.groupBy("current_account_nbr").agg(m.cast("long").alias("return_check_cnt_total"),
                                                F.count("return_check_cnt_last_mth").alias("statement_count"))


def _dk_sql() -> str:
    return with_roles("account_dim", "identity_map") + """
SELECT DISTINCT i.ds_id AS user_id FROM account_dim a JOIN identity_map i ON i.account_nbr_pty = a.current_account_nbr"""


@query("distinct_keys", _dk_sql)
def distinct_keys(spark, sf_dir):
    """AGG-08: distinct user keys (fallback user list)."""
    t = Tables(spark, sf_dir)
    a = roles.account_dim(t).select("current_account_nbr")
    m = roles.identity_map(t).select(F.col("account_nbr_pty").alias("current_account_nbr"), F.col("ds_id").alias("user_id"))
    return a.join(m, "current_account_nbr").select("user_id").distinct()


def _cc_sql() -> str:
    return OM.user_view_ctes() + f"""
SELECT segment_label, count(*) AS n, {r6s('count(*) * 1.0 / (SELECT count(*) FROM um)')} AS share FROM um GROUP BY 1"""


@query("class_counts", _cc_sql)
def class_counts(spark, sf_dir):
    """AGG-16: class counts and shares (bincount)."""
    u = user_view(spark, sf_dir)
    n = u.select(F.count("*")).scalar()
    return u.groupBy("segment_label").agg(F.count("*").alias("n")).withColumn("share", r6(F.col("n") * 1.0 / n))


def _tr_sql() -> str:
    return OM.scored_ctes() + f"""
SELECT min(CLI_target_amount) AS min_target, max(CLI_target_amount) AS max_target,
       {r6s('avg(CLI_target_amount)')} AS mean_target,
       {r6s('CAST(sum(CAST(CLI_target_amount AS DECIMAL(38,9))) AS DOUBLE)')} AS sum_target
FROM scored WHERE segment_label IN (0, 1)"""


@query("target_range", _tr_sql)
def target_range(spark, sf_dir):
    """AGG-34: min / max / mean / sum of the increase target."""
    from creditlens.operators.reports import exact_sum
    s = scored_view(spark, sf_dir).filter(F.col("segment_label").isin(0, 1))
    return s.agg(F.min("CLI_target_amount").alias("min_target"), F.max("CLI_target_amount").alias("max_target"),
                 r6(F.avg("CLI_target_amount")).alias("mean_target"),
                 r6(exact_sum("CLI_target_amount")).alias("sum_target"))


def _union_sql() -> str:
    return with_roles("domestic_transactions", "foreign_transactions") + """
SELECT current_account_nbr, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_type,
       CAST(transaction_amt AS DOUBLE) AS transaction_amt, CAST(us_equiv_amt AS DOUBLE) AS us_equiv_amt
FROM (SELECT *, NULL AS us_equiv_amt FROM domestic_transactions UNION ALL BY NAME SELECT * FROM foreign_transactions)"""


@query("union_transactions", _union_sql)
def union_transactions(spark, sf_dir):
    """SET-01: union by name, columns missing on one side become NULL."""
    t = Tables(spark, sf_dir)
    u = roles.domestic_transactions(t).unionByName(roles.foreign_transactions(t), allowMissingColumns=True)
    return u.select("current_account_nbr", F.col("transaction_date").cast("string").alias("transaction_date"),
                    "transaction_type", F.col("transaction_amt").cast("double").alias("transaction_amt"),
                    F.col("us_equiv_amt").cast("double").alias("us_equiv_amt"))


# --------------------------------------------------------------- sorting

def _sf_sql() -> str:
    return OM.user_view_ctes() + f"""
SELECT num_accounts, count(*) AS n_users, {r6s('count(*) * 100.0 / (SELECT count(*) FROM um)')} AS pct
FROM um GROUP BY 1 ORDER BY num_accounts"""


@query("sorted_frequency", _sf_sql)
def sorted_frequency(spark, sf_dir):
    """SRT-04 + AGG-15: frequency table ordered by value."""
    u = user_view(spark, sf_dir)
    n = u.select(F.count("*")).scalar()
    return (u.groupBy("num_accounts").agg(F.count("*").alias("n_users"))
            .withColumn("pct", r6(F.col("n_users") * 100.0 / n)).orderBy("num_accounts"))


def _head_sql() -> str:
    return OM.user_view_ctes() + "\nSELECT user_id, num_accounts, credit_line FROM um ORDER BY user_id LIMIT 10"


@query("head_rows", _head_sql)
def head_rows(spark, sf_dir):
    """SRT-05 + SRC-04: the first rows under a total order (the feature is
    the limit itself)."""
    return user_view(spark, sf_dir).orderBy("user_id").limit(10).select("user_id", "num_accounts", "credit_line")


# ----------------------------------------------------------------- dates

def _text_dates(t):
    o = t.orders
    k = F.col("o_orderkey")
    txt = (F.when(k % 13 == 0, F.lit("not a date")).when(k % 17 == 0, F.lit("1997-02-30"))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select(k.alias("current_account_nbr"), txt.alias("open_date_text"))


_TEXT_DATES_SQL = """
SELECT o_orderkey AS current_account_nbr,
       CASE WHEN o_orderkey % 13 = 0 THEN 'not a date' WHEN o_orderkey % 17 = 0 THEN '1997-02-30'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS open_date_text FROM orders"""


@query("lenient_dates", lambda: f"""WITH d AS ({_TEXT_DATES_SQL})
SELECT current_account_nbr, open_date_text,
       CAST(CAST(try_strptime(open_date_text, '%Y-%m-%d') AS DATE) AS VARCHAR) AS open_date FROM d""")
def lenient_dates(spark, sf_dir):
    """DAT-01: lenient parse, broken text -> NULL (never an error)."""
    d = _text_dates(Tables(spark, sf_dir))
    return d.select("current_account_nbr", "open_date_text",
                    C.lenient_date("open_date_text").cast("string").alias("open_date"))


@query("pattern_dates", lambda: f"""WITH d AS ({_TEXT_DATES_SQL})
SELECT current_account_nbr, CAST(CAST(strptime(open_date_text, '%Y-%m-%d') AS DATE) AS VARCHAR) AS open_date,
       CAST(year(CAST(strptime(open_date_text, '%Y-%m-%d') AS DATE)) AS INTEGER) AS open_year
FROM d WHERE try_strptime(open_date_text, '%Y-%m-%d') IS NOT NULL""")
def pattern_dates(spark, sf_dir):
    """DAT-09 + DAT-06: strict ``yyyy-MM-dd`` parse of the valid texts, year."""
    d = _text_dates(Tables(spark, sf_dir))
    p = F.to_date(F.try_to_timestamp("open_date_text", F.lit("yyyy-MM-dd")))
    v = d.filter(p.isNotNull())
    s = F.to_date("open_date_text", "yyyy-MM-dd")
    return v.select("current_account_nbr", s.cast("string").alias("open_date"), F.year(s).alias("open_year"))


def _utc_text(t):
    e = t.events
    off = (F.col("event_id") % 5).cast("string")
    return e.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0"), off,
                                         F.lit(":00")).alias("ts_text"))


@query("utc_dates", lambda: """
WITH d AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0' || CAST(event_id % 5 AS VARCHAR) || ':00'
                  AS ts_text FROM events)
SELECT event_id, ts_text, CAST(epoch(strptime(ts_text, '%Y-%m-%dT%H:%M:%S%z')) AS BIGINT) AS epoch_utc,
       CAST(CAST(timezone('UTC', strptime(ts_text, '%Y-%m-%dT%H:%M:%S%z')) AS DATE) AS VARCHAR) AS date_utc
FROM d""")
def utc_dates(spark, sf_dir):
    """DAT-02 + DAT-03: timestamps with offsets parsed to UTC instants (the
    session time zone is UTC, so no explicit localisation step)."""
    d = _utc_text(Tables(spark, sf_dir))
    ts = F.to_timestamp("ts_text", "yyyy-MM-dd'T'HH:mm:ssXXX")
    epoch = F.unix_timestamp(ts)
    # the UTC calendar day from the instant itself (independent of the session time zone)
    return d.select("event_id", "ts_text", epoch.alias("epoch_utc"),
                    F.date_from_unix_date(F.floor(epoch / 86400).cast("int")).cast("string").alias("date_utc"))


# ----------------------------------------------------------------- maths

def _math_sql() -> str:
    return OM.user_view_ctes() + """
SELECT user_id,
       CASE WHEN credit_line > 0 THEN current_balance / credit_line * 100.0 END AS utilisation,
       CASE WHEN total_transactions_2024 > 0 THEN total_spend_2024 / total_transactions_2024 ELSE 0.0 END
           AS avg_transaction_size,
       CASE WHEN spend_2024_q2 > 0 THEN (spend_2024_q3 - spend_2024_q2) / greatest(1.0, spend_2024_q2) ELSE 0.0 END
           AS growth_clipped_raw,
       CASE WHEN spend_2024_q1 > 0 THEN (spend_2024_q2 - spend_2024_q1) / spend_2024_q1 ELSE 0.0 END AS growth_q1_q2,
       total_spend_2024 / 12 AS monthly_from_annual, avg_monthly_spend_2024 * 12 AS annual_from_monthly,
       greatest(credit_score, 600.0) AS score_floor, least(utilization_pct, 100.0) AS util_cap,
       sqrt(abs(spend_2024_q4 - spend_2024_q3)) AS sqrt_abs_diff
FROM um"""


@query("utilisation_and_growth", _math_sql)
def utilisation_and_growth(spark, sf_dir):
    """MTH-01 guarded ratio, MTH-02 guarded average, MTH-04 growth, MTH-06
    element-wise max/min, MTH-07 sqrt/abs, MTH-09 annual <-> monthly."""
    u = user_view(spark, sf_dir)
    a = F.col("spend_2024_q2")
    raw = F.when(a > 0, (F.col("spend_2024_q3") - a) / F.greatest(F.lit(1.0), a)).otherwise(F.lit(0.0))
    return u.select("user_id", R.guarded_pct("current_balance", "credit_line").alias("utilisation"),
                    R.guarded_avg("total_spend_2024", "total_transactions_2024").alias("avg_transaction_size"),
                    raw.alias("growth_clipped_raw"),
                    R.growth("spend_2024_q1", "spend_2024_q2").alias("growth_q1_q2"),
                    (F.col("total_spend_2024") / 12).alias("monthly_from_annual"),
                    (F.col("avg_monthly_spend_2024") * 12).alias("annual_from_monthly"),
                    F.greatest(F.col("credit_score"), F.lit(600.0)).alias("score_floor"),
                    F.least(F.col("utilization_pct"), F.lit(100.0)).alias("util_cap"),
                    F.sqrt(F.abs(F.col("spend_2024_q4") - F.col("spend_2024_q3"))).alias("sqrt_abs_diff"))


def _growth_sql() -> str:
    def clip(e, lo, hi):
        return f"(CASE WHEN {e} < {lo} THEN {lo} WHEN {e} > {hi} THEN {hi} ELSE {e} END)"
    g3 = "(CASE WHEN spend_2024_q2 > 0 THEN (spend_2024_q3 - spend_2024_q2) / greatest(1.0, spend_2024_q2) ELSE 0.0 END)"
    r = "coalesce(CASE WHEN {a} <> 0 THEN {b} / {a} END, 1.0)"
    r21 = clip(r.format(a="spend_2024_q1", b="spend_2024_q2"), 0.0, 5.0)
    r32 = clip(r.format(a="spend_2024_q2", b="spend_2024_q3"), 0.0, 5.0)
    r43 = clip(r.format(a="spend_2024_q3", b="spend_2024_q4"), 0.0, 5.0)
    return OM.user_view_ctes() + f"""
SELECT user_id, {clip(g3, -5.0, 5.0)} AS q2_to_q3_growth, {r21} AS q2_q1_growth, {r32} AS q3_q2_growth,
       {r43} AS q4_q3_growth, 0.2 * {r21} + 0.3 * {r32} + 0.5 * {r43} AS growth_trajectory
FROM um"""


@query("weighted_growth", _growth_sql)
def weighted_growth(spark, sf_dir):
    """MTH-03 clipped growth, MTH-05 ratio growth, MTH-08 weighted sum."""
    u = user_view(spark, sf_dir)
    r21 = R.ratio_growth("spend_2024_q1", "spend_2024_q2")
    r32 = R.ratio_growth("spend_2024_q2", "spend_2024_q3")
    r43 = R.ratio_growth("spend_2024_q3", "spend_2024_q4")
    return u.select("user_id", R.growth_clipped("spend_2024_q2", "spend_2024_q3").alias("q2_to_q3_growth"),
                    r21.alias("q2_q1_growth"), r32.alias("q3_q2_growth"), r43.alias("q4_q3_growth"),
                    (0.2 * r21 + 0.3 * r32 + 0.5 * r43).alias("growth_trajectory"))


# -------------------------------------------------------------- entities

def _ent_acc_sql() -> str:
    return with_roles("account_dim", "identity_map", "statement_fact", "transactions", "fraud_claim_case",
                      "fraud_claim_tran") + """,
st AS (SELECT current_account_nbr, count(*) AS n FROM statement_fact GROUP BY 1),
tx AS (SELECT current_account_nbr, count(*) AS n, count(us_equiv_amt) AS n_foreign,
              CAST(min(transaction_date) AS VARCHAR) AS first_tx, CAST(max(transaction_date) AS VARCHAR) AS last_tx
       FROM transactions GROUP BY 1),
fc AS (SELECT current_account_nbr, count(DISTINCT case_id) AS n, min(case_id) AS first_case FROM fraud_claim_case GROUP BY 1),
ft AS (SELECT current_account_nbr, count(*) AS n FROM fraud_claim_tran GROUP BY 1)
SELECT a.current_account_nbr, a.client_id, i.ds_id AS user_id,
       coalesce(st.n, 0) AS n_statements, coalesce(tx.n, 0) AS n_transactions, coalesce(tx.n_foreign, 0) AS n_foreign,
       tx.first_tx, tx.last_tx, coalesce(fc.n, 0) AS n_fraud_cases, fc.first_case,
       coalesce(ft.n, 0) AS n_fraud_transactions
FROM account_dim a LEFT JOIN identity_map i ON i.account_nbr_pty = a.current_account_nbr
LEFT JOIN st ON st.current_account_nbr = a.current_account_nbr
LEFT JOIN tx ON tx.current_account_nbr = a.current_account_nbr
LEFT JOIN fc ON fc.current_account_nbr = a.current_account_nbr
LEFT JOIN ft ON ft.current_account_nbr = a.current_account_nbr"""


@query("entity_accounts", _ent_acc_sql)
def entity_accounts(spark, sf_dir):
    """AGG-26 (accounts): the account entity as flat aggregates per source —
    sizes of each related collection and its first / last keys — joined on
    the account key.  The related rows stay in their own tables (no
    unbounded per-account arrays)."""
    from creditlens.operators.entities import account_entities
    return account_entities(Tables(spark, sf_dir))


def _ent_fraud_sql() -> str:
    return with_roles("fraud_claim_case", "fraud_claim_tran") + """,
c AS (SELECT case_id, count(*) AS n_claims, count(DISTINCT current_account_nbr) AS n_accounts,
             CAST(sum(gross_fraud_amt) AS DOUBLE) AS gross, CAST(sum(net_fraud_amt) AS DOUBLE) AS net,
             CAST(min(reported_date) AS VARCHAR) AS first_reported FROM fraud_claim_case GROUP BY 1),
t AS (SELECT case_id, count(*) AS n_tx, CAST(sum(transaction_am) AS DOUBLE) AS tx_amount,
             CAST(max(transaction_dt) AS VARCHAR) AS last_tx FROM fraud_claim_tran GROUP BY 1)
SELECT coalesce(c.case_id, t.case_id) AS case_id, coalesce(c.n_claims, 0) AS n_claims,
       coalesce(c.n_accounts, 0) AS n_accounts, c.gross AS gross_fraud_amt, c.net AS net_fraud_amt, c.first_reported,
       coalesce(t.n_tx, 0) AS n_transactions, t.tx_amount, t.last_tx
FROM c FULL OUTER JOIN t ON t.case_id = c.case_id"""


@query("entity_fraud", _ent_fraud_sql)
def entity_fraud(spark, sf_dir):
    """AGG-26 (fraud cases): claim rows and transaction rows summarised per
    case, full outer join so cases seen in only one source survive."""
    from creditlens.operators.entities import fraud_case_entities
    return fraud_case_entities(Tables(spark, sf_dir))


def _ent_user_sql() -> str:
    return with_roles("identity_map") + """
SELECT ds_id AS user_id, count(DISTINCT account_nbr_pty) AS n_accounts, min(account_nbr_pty) AS first_account,
       max(account_nbr_pty) AS last_account
FROM identity_map WHERE ds_id IS NOT NULL GROUP BY 1"""


@query("entity_users", _ent_user_sql)
def entity_users(spark, sf_dir):
    """AGG-26 (users / clients): account set per user as size and key range."""
    m = roles.identity_map(Tables(spark, sf_dir)).filter(F.col("ds_id").isNotNull())
    return m.groupBy(F.col("ds_id").alias("user_id")).agg(
        F.count_distinct("account_nbr_pty").alias("n_accounts"), F.min("account_nbr_pty").alias("first_account"),
        F.max("account_nbr_pty").alias("last_account"))


# ------------------------------------------------ single-operator queries
# (the registry names of SURVEY §7.4 for operators that the combined
# queries above also exercise)

@query("segment_a", lambda: OM.user_view_ctes() + """
SELECT user_id, CASE WHEN ((utilization_pct > 70) OR (credit_score < 670)) AND (risk_flag = 0) THEN 1
                     WHEN (utilization_pct > 30) AND (utilization_pct <= 70) AND (credit_score >= 670)
                          AND (risk_flag = 0) THEN 0
                     WHEN risk_flag = 1 THEN 3 ELSE 2 END AS segment FROM um""")
def segment_a(spark, sf_dir):
    """RUL-09: master segmentation rule."""
    u = user_view(spark, sf_dir)
    return u.select("user_id", R.segment_a("utilization_pct", "credit_score", "risk_flag").alias("segment"))


@query("segment_b", lambda: OM.user_view_ctes() + """
SELECT user_id, CASE WHEN (utilization_pct > 30) AND (utilization_pct <= 70) AND (credit_score >= 670)
                          AND NOT coalesce(risk_flag = 1, false) THEN 0
                     WHEN ((utilization_pct > 70) OR (credit_score < 670)) AND NOT coalesce(risk_flag = 1, false)
                          AND NOT coalesce(utilization_pct <= 30, false) THEN 1
                     WHEN (utilization_pct <= 30) AND NOT coalesce(risk_flag = 1, false) THEN 2
                     WHEN risk_flag = 1 THEN 3 ELSE 2 END AS segment FROM um""")
def segment_b(spark, sf_dir):
    """RUL-10: model / scoring segmentation rule (utilisation <= 30 stays 2)."""
    u = user_view(spark, sf_dir)
    return u.select("user_id", R.segment_b("utilization_pct", "credit_score", "risk_flag").alias("segment"))


@query("utilisation", lambda: OM.user_ctes() + """
SELECT user_id, CASE WHEN credit_line > 0 THEN current_balance / credit_line * 100.0 END AS utilization_pct
FROM ufin""")
def utilisation(spark, sf_dir):
    """MTH-01 / RUL-03: guarded utilisation on user totals (before scaling)."""
    from creditlens.plans.q_core import user_rollup_q
    u = user_rollup_q(spark, sf_dir)
    return u.select("user_id", R.guarded_pct("current_balance", "credit_line").alias("utilization_pct"))


@query("avg_transaction_size", lambda: with_roles("transactions") + f""",
s AS (SELECT current_account_nbr, transaction_date, transaction_type,
             CASE WHEN transaction_type = 'RETURN' THEN -(CASE WHEN us_equiv_amt IS NULL OR us_equiv_amt = 0
                  THEN transaction_amt ELSE us_equiv_amt END) ELSE (CASE WHEN us_equiv_amt IS NULL OR us_equiv_amt = 0
                  THEN transaction_amt ELSE us_equiv_amt END) END AS signed_amount FROM transactions),
p AS (SELECT current_account_nbr,
             coalesce(sum(CASE WHEN transaction_date BETWEEN DATE '{PERIODS.year[0]}' AND DATE '{PERIODS.year[1]}'
                          THEN signed_amount END), 0) AS spend,
             count(*) FILTER (WHERE transaction_date BETWEEN DATE '{PERIODS.year[0]}' AND DATE '{PERIODS.year[1]}'
                              AND transaction_type = 'SALE') AS n
      FROM s GROUP BY 1)
SELECT current_account_nbr, CASE WHEN n > 0 THEN CAST(spend AS DOUBLE) / CAST(n AS DOUBLE) ELSE 0.0 END
    AS avg_transaction_size_2024 FROM p""")
def avg_transaction_size(spark, sf_dir):
    """MTH-02: guarded average transaction size per account (0 without purchases)."""
    from creditlens.operators.rollup import period_pivot
    p = period_pivot(roles.transactions(Tables(spark, sf_dir)))
    return p.select("current_account_nbr",
                    R.guarded_avg("total_spend_2024", "total_transactions_2024").alias("avg_transaction_size_2024"))


def _qg_sql() -> str:
    g3 = "(CASE WHEN spend_2024_q2 > 0 THEN (spend_2024_q3 - spend_2024_q2) / greatest(1.0, spend_2024_q2) ELSE 0.0 END)"
    clipped = f"(CASE WHEN {g3} < -5.0 THEN -5.0 WHEN {g3} > 5.0 THEN 5.0 ELSE {g3} END)"
    return OM.user_view_ctes() + f"""
SELECT user_id, {clipped} AS q2_to_q3_growth,
       CASE WHEN spend_2024_q1 > 0 THEN (spend_2024_q2 - spend_2024_q1) / spend_2024_q1 ELSE 0.0 END AS q1_to_q2_growth,
       CASE WHEN coalesce(CASE WHEN spend_2024_q3 <> 0 THEN spend_2024_q4 / spend_2024_q3 END, 1.0) < 0 THEN 0.0
            WHEN coalesce(CASE WHEN spend_2024_q3 <> 0 THEN spend_2024_q4 / spend_2024_q3 END, 1.0) > 5 THEN 5.0
            ELSE coalesce(CASE WHEN spend_2024_q3 <> 0 THEN spend_2024_q4 / spend_2024_q3 END, 1.0) END AS q4_q3_growth
FROM um"""


@query("quarter_growth", _qg_sql)
def quarter_growth(spark, sf_dir):
    """MTH-03 (clipped growth), MTH-04 (plain growth), MTH-05 (ratio growth)."""
    u = user_view(spark, sf_dir)
    return u.select("user_id", R.growth_clipped("spend_2024_q2", "spend_2024_q3").alias("q2_to_q3_growth"),
                    R.growth("spend_2024_q1", "spend_2024_q2").alias("q1_to_q2_growth"),
                    R.ratio_growth("spend_2024_q3", "spend_2024_q4").alias("q4_q3_growth"))


@query("annual_monthly", lambda: OM.user_view_ctes() + """
SELECT user_id, total_spend_2024 / 12 AS monthly_from_annual, avg_monthly_spend_2024 * 12 AS annual_from_monthly,
       credit_line * utilization_pct / 100 AS balance_from_utilisation FROM um""")
def annual_monthly(spark, sf_dir):
    """MTH-09 + RUL-23: annual <-> monthly and balance from line x utilisation."""
    u = user_view(spark, sf_dir)
    return u.select("user_id", (F.col("total_spend_2024") / 12).alias("monthly_from_annual"),
                    (F.col("avg_monthly_spend_2024") * 12).alias("annual_from_monthly"),
                    (F.col("credit_line") * F.col("utilization_pct") / 100).alias("balance_from_utilisation"))


@query("status_description_fill", lambda: with_roles("account_dim") + """
SELECT current_account_nbr, external_status_reason_code,
       CASE WHEN ext_status_reason_cd_desc IS NULL AND coalesce(external_status_reason_code = 0, false) THEN 'Normal'
            WHEN ext_status_reason_cd_desc IS NULL AND NOT coalesce(external_status_reason_code = 0, false) THEN 'Other'
            ELSE ext_status_reason_cd_desc END AS ext_status_reason_cd_desc
FROM account_dim""")
def status_description_fill(spark, sf_dir):
    """PRJ-10: nested conditional fill of the status description."""
    a = roles.account_dim(Tables(spark, sf_dir))
    return a.select("current_account_nbr", "external_status_reason_code",
                    C.status_description("ext_status_reason_cd_desc", "external_status_reason_code")
                    .alias("ext_status_reason_cd_desc"))


@query("sentinel_recode", lambda: with_roles("statement_fact") + """
SELECT current_account_nbr, return_check_cnt_last_mth AS raw_value,
       CASE WHEN return_check_cnt_last_mth = 99 THEN 0 ELSE return_check_cnt_last_mth END AS recoded
FROM statement_fact""")
def sentinel_recode(spark, sf_dir):
    """PRJ-16: sentinel 99 -> 0."""
    s = roles.statement_fact(Tables(spark, sf_dir))
    return s.select("current_account_nbr", F.col("return_check_cnt_last_mth").alias("raw_value"),
                    R.sentinel_recode("return_check_cnt_last_mth", 99, 0).alias("recoded"))

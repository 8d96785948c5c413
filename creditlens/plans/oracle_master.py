"""Oracle SQL for the master build (account table, user rollup, user master)."""

from __future__ import annotations

from creditlens.functions import rules as R
from creditlens.operators.rollup import COUNT_COLS, SPEND_COLS, ZERO_PREFIXES, ZERO_SUFFIXES
from creditlens.operators.sampling import key_hash_sql
from creditlens.plans import sqlparts as Q
from creditlens.sources.roles import PERIODS, with_roles

ROLES = ("account_dim", "identity_map", "statement_fact", "transactions", "fraud_claim_case",
         "fraud_claim_tran", "credit_snapshot")


def account_ctes() -> str:
    lo, hi = PERIODS.span()
    ph = ",\n".join(Q.payment_history_sql(f"a.payment_hist_{p}_mths", f"payment_hist_{p}_") for p in ("1_12", "13_24"))
    return with_roles(*ROLES) + f""",
idm AS (SELECT account_nbr_pty AS current_account_nbr, ds_id AS user_id FROM identity_map
        WHERE account_nbr_pty IS NOT NULL AND ds_id IS NOT NULL),
stmt AS (SELECT current_account_nbr, CAST(sum(return_check_cnt_total) AS BIGINT) AS return_check_cnt_total
         FROM statement_fact GROUP BY 1),
tx AS (SELECT current_account_nbr, transaction_date, transaction_type, {Q.signed_amount_sql()} AS signed_amount
       FROM transactions WHERE transaction_date BETWEEN DATE '{lo}' AND DATE '{hi}'),
piv AS ({Q.period_pivot_sql('tx')}),
cases AS (SELECT current_account_nbr, 1 AS has_fraud FROM fraud_claim_case GROUP BY 1),
ft AS (SELECT current_account_nbr, count(transaction_am) AS fraud_transaction_count,
              sum(transaction_am) AS fraud_transaction_sum,
              CAST(sum(transaction_am) AS DOUBLE) / count(transaction_am) AS fraud_transaction_avg,
              max(transaction_am) AS fraud_transaction_max, min(transaction_am) AS fraud_transaction_min,
              count(DISTINCT case_id) AS fraud_case_count
       FROM fraud_claim_tran GROUP BY 1),
acct AS (
  SELECT a.current_account_nbr, idm.user_id,
         CASE WHEN a.employee_code IS NULL OR a.employee_code = 'Y' THEN 0 WHEN a.employee_code = 'H' THEN 1 END
             AS is_high_income,
         a.open_date, a.card_activation_date, a.closed_date,
         stmt.return_check_cnt_total,
         {", ".join(f"piv.{c}" for c in SPEND_COLS + COUNT_COLS)},
         CAST(coalesce(cases.has_fraud, 0) AS INTEGER) AS has_fraud,
         coalesce(ft.fraud_transaction_count, 0) AS fraud_transaction_count,
         coalesce(ft.fraud_transaction_sum, 0) AS fraud_transaction_sum,
         coalesce(ft.fraud_transaction_avg, 0) AS fraud_transaction_avg,
         coalesce(ft.fraud_transaction_max, 0) AS fraud_transaction_max,
         coalesce(ft.fraud_transaction_min, 0) AS fraud_transaction_min,
         coalesce(ft.fraud_case_count, 0) AS fraud_case_count,
         s.cu_crd_line AS credit_line, s.cu_cur_balance AS current_balance,
         s.cu_bhv_scr AS behavior_score, s.cu_crd_bureau_scr AS credit_score,
         {ph},
         CAST(DATE '{PERIODS.ref_date}' - a.open_date AS INTEGER) AS account_age_days,
         CAST(CASE WHEN a.card_activation_date IS NOT NULL AND a.open_date IS NOT NULL
              THEN a.card_activation_date - a.open_date END AS INTEGER) AS activation_delay_days,
         CASE WHEN piv.total_transactions_2024 > 0
              THEN CAST(piv.total_spend_2024 AS DOUBLE) / CAST(piv.total_transactions_2024 AS DOUBLE) ELSE 0.0 END
             AS avg_transaction_size_2024,
         CAST(a.closed_date IS NULL AS INTEGER) AS is_active_account
  FROM account_dim a JOIN idm ON idm.current_account_nbr = a.current_account_nbr
  LEFT JOIN stmt ON stmt.current_account_nbr = a.current_account_nbr
  LEFT JOIN piv ON piv.current_account_nbr = a.current_account_nbr
  LEFT JOIN cases ON cases.current_account_nbr = a.current_account_nbr
  LEFT JOIN ft ON ft.current_account_nbr = a.current_account_nbr
  LEFT JOIN credit_snapshot s ON s.cu_account_nbr = a.current_account_nbr)"""


PH_COLS = [f"payment_hist_{p}_{m}" for p in ("1_12", "13_24") for m in R.PAYMENT_METRICS]


def user_ctes() -> str:
    sums = SPEND_COLS + COUNT_COLS + ["credit_line", "current_balance"]
    parts = []
    for c in sums:
        if c in COUNT_COLS:
            parts.append(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}")
        else:
            parts.append(f"CAST(coalesce(sum({c}), 0) AS DOUBLE) AS {c}")
    parts += ["min(behavior_score) AS behavior_score", "min(credit_score) AS credit_score",
              "max(is_high_income) AS is_high_income", "max(has_fraud) AS has_fraud",
              "CAST(coalesce(sum(fraud_transaction_count), 0) AS BIGINT) AS fraud_transaction_count",
              "CAST(coalesce(sum(fraud_transaction_sum), 0) AS DOUBLE) AS fraud_transaction_sum",
              "CAST(coalesce(sum(fraud_case_count), 0) AS BIGINT) AS fraud_case_count",
              "CAST(max(fraud_transaction_max) AS DOUBLE) AS fraud_transaction_max",
              "CAST(max(fraud_transaction_min) AS DOUBLE) AS fraud_transaction_min",
              "CAST(sum(CAST(fraud_transaction_avg AS DECIMAL(38,9))) AS DOUBLE) / count(fraud_transaction_avg) AS fraud_transaction_avg"]
    parts += [f"max({c}) AS {c}" for c in PH_COLS]
    parts += ["avg(account_age_days) AS account_age_days", "avg(activation_delay_days) AS activation_delay_days",
              "CAST(sum(CAST(avg_transaction_size_2024 AS DECIMAL(38,9))) AS DOUBLE) / count(avg_transaction_size_2024) AS avg_transaction_size_2024",
              "CAST(coalesce(sum(is_active_account), 0) AS BIGINT) AS active_account_count"]
    return account_ctes() + f""",
urollup AS (SELECT user_id, {", ".join(parts)} FROM acct WHERE user_id IS NOT NULL GROUP BY user_id),
ucount AS (SELECT ds_id AS user_id, count(DISTINCT account_nbr_pty) AS num_accounts
           FROM identity_map WHERE ds_id IS NOT NULL GROUP BY 1),
ufin AS (SELECT r.*, c.num_accounts,
                CAST(r.active_account_count > 0 AS INTEGER) AS user_active_flag,
                CASE WHEN r.credit_line > 0 THEN r.current_balance / r.credit_line * 100.0 END AS utilization_pct,
                r.total_spend_2024 / 12.0 AS avg_monthly_spend_2024
         FROM urollup r LEFT JOIN ucount c ON c.user_id = r.user_id)"""


USER_NUMERIC = (SPEND_COLS + COUNT_COLS + ["credit_line", "current_balance", "behavior_score", "credit_score",
                "is_high_income", "has_fraud", "fraud_transaction_count", "fraud_transaction_sum",
                "fraud_case_count", "fraud_transaction_max", "fraud_transaction_min", "fraud_transaction_avg"]
                + PH_COLS + ["account_age_days", "activation_delay_days", "avg_transaction_size_2024",
                             "active_account_count", "num_accounts", "user_active_flag", "utilization_pct",
                             "avg_monthly_spend_2024"])


def _is_zero(c: str) -> bool:
    return c.startswith(ZERO_PREFIXES) or c.endswith(ZERO_SUFFIXES)


def imputed_select(src: str, cols, key="user_id", scale=("credit_line", "current_balance")) -> str:
    """PRJ-22/23/24 over ``src``: zero fill for count-like names, median for
    the rest (as DOUBLE), then thousands scaling."""
    out = [key]
    for c in cols:
        if _is_zero(c):
            e = f"coalesce({c}, 0)"
        else:
            d = f"CAST({c} AS DOUBLE)"
            v = f"(CASE WHEN isinf({d}) OR isnan({d}) THEN NULL ELSE {d} END)"
            # median with the same interpolation formula as Spark's percentile
            e = f"coalesce({v}, (SELECT q0 FROM ({Q.quantile_sql(src, v, [0.5])})))"
        if c in scale:
            e = f"{e} / 1000"
        out.append(f"{e} AS {c}")
    return f"SELECT {', '.join(out)} FROM {src}"


def _quota_sql(src: str, flag: str, quota: float, seed, out: str) -> str:
    """SMP-03 twin: flag the needed unflagged rows of smallest hash."""
    h = key_hash_sql(["user_id"], seed)
    return f"""SELECT * EXCLUDE (_rn, _need), CASE WHEN {flag} = 1 THEN 1 WHEN _rn <= _need THEN 1 ELSE 0 END AS {out}
FROM (SELECT s.*,
             CASE WHEN {flag} = 0 THEN row_number() OVER (PARTITION BY ({flag} = 0) ORDER BY {h}) END AS _rn,
             (SELECT CASE WHEN avg({flag}) < {quota}
                          THEN CAST(floor(CAST(count(*) AS DOUBLE) * {quota}) AS BIGINT) - sum({flag}) ELSE 0 END
              FROM {src}) AS _need
      FROM {src} s)"""


def _fill_empty_sql(prev: str, seg: int, seed) -> str:
    """SMP-04(a) twin for one target segment."""
    pool = "(2)" if seg < 2 else "(0, 1)"
    h = key_hash_sql(["user_id"], f"{seed}-{seg}")
    return f"""SELECT * EXCLUDE (segment_label, _rn),
       CASE WHEN _rn <= (SELECT CASE WHEN count(*) FILTER (WHERE segment_label = {seg}) = 0
                                     THEN least(greatest(CAST(floor(CAST(count(*) AS DOUBLE) * 0.05) AS BIGINT), 1),
                                                count(*) FILTER (WHERE segment_label IN {pool}))
                                     ELSE 0 END FROM {prev})
            THEN {seg} ELSE segment_label END AS segment_label
FROM (SELECT p.*, CASE WHEN segment_label IN {pool}
                       THEN row_number() OVER (PARTITION BY (segment_label IN {pool}) ORDER BY {h}) END AS _rn
      FROM {prev} p)"""


def user_view_ctes(seed=42) -> str:
    """CTE chain ending in ``um`` (the master user table)."""
    dc12, dc24 = "payment_hist_1_12_delinquency_count", "payment_hist_13_24_delinquency_count"
    risk0 = (f"CAST((coalesce({dc12} > 3, false) OR coalesce({dc24} > 3, false) "
             f"OR coalesce(utilization_pct > 95 AND credit_score < 600, false)) AS INTEGER)")
    return user_ctes() + f""",
uimp AS ({imputed_select('ufin', USER_NUMERIC)}),
ulab AS (SELECT *, CAST(coalesce({dc12} > 0, false) AS INTEGER) AS delinquency_12mo,
                CAST(coalesce({dc24} > 0, false) AS INTEGER) AS delinquency_24mo,
                {risk0} AS risk0
         FROM uimp),
uq AS ({_quota_sql('ulab', 'risk0', 0.08, seed, 'risk_flag')}),
us0 AS (SELECT * EXCLUDE (risk0), {Q.segment_a_sql()} AS segment_label FROM uq),
us1 AS ({_fill_empty_sql('us0', 0, seed)}),
us2 AS ({_fill_empty_sql('us1', 1, seed)}),
us3 AS ({_fill_empty_sql('us2', 2, seed)}),
us4 AS ({_fill_empty_sql('us3', 3, seed)}),
um AS (SELECT *, {Q.risk_probability_sql()} AS risk_probability FROM us4)"""


def user_master_sql(seed=42) -> str:
    return user_view_ctes(seed) + "\nSELECT * FROM um"


def scored_ctes() -> str:
    """``um`` plus ``scored`` (rule-based scores, twin of operators.scoring)."""
    m = Q.macro_sql()
    pct = Q.max_cli_pct_sql()
    post = Q.cli_postprocess_sql("CLI_target_amount", "credit_line", "max_cli_percentage",
                                 "segment_label IN (0, 1)", "is_high_income")
    return user_view_ctes() + f""",
sc1 AS (SELECT *, {m['economic_factor']} AS economic_factor, {m['seasonal_index']} AS seasonal_index,
               {m['spending_elasticity']} AS spending_elasticity,
               {m['q4_adjustment_factor']} AS q4_adjustment_factor,
               CAST(1.25 AS DOUBLE) AS holiday_spending_multiplier,
               avg_monthly_spend_2024 * 1.25 * (1.0 + 0.2 * is_high_income) AS holiday_spending_power,
               total_spend_2024 * 0.3 AS spend_Q4_2024,
               total_spend_2024 * 0.3 * 1.05 AS predicted_q4_spend,
               {pct} AS max_cli_percentage
        FROM um),
sc2 AS (SELECT *, credit_line * 1000 * max_cli_percentage AS CLI_target_amount FROM sc1),
scored AS (SELECT *, {post} AS recommended_cli_amount FROM sc2)"""


def account_table_sql() -> str:
    return account_ctes() + "\nSELECT * FROM acct"

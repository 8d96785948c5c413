"""Account- and user-level rollups (the master build).

Plan shape, chosen for scale:

* every fact is aggregated to one row per account *before* it meets the
  account spine (over the driver tables dealt by account first, as an
  account's sums are wider than its rows), then left-joined on ``current_account_nbr`` — all those joins
  share one hash partitioning of the spine, so the chain adds no shuffles of
  the spine itself;
* the transaction period pivot is one conditional aggregate (12 measures in a
  single ``HashAggregate``) with the reporting span pushed into the scan;
* the user rollup is one ``groupBy(user_id).agg(...)`` over accounts dealt by
  user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from creditlens.functions import rules as R
from creditlens.sources import roles
from creditlens.sources.extracts import Sources, as_sources
from creditlens.sources.roles import PERIODS, Periods

# Spend / count measure names per reporting period
SPEND_MEASURES = (
    # (spend column, count column, period attribute)
    ("total_spend_2024", "total_transactions_2024", "year"),
    ("total_spend_2025YTD", "total_transactions_2025YTD", "ytd"),
    ("spend_2024_q1", "transactions_2024_q1", "q1"),
    ("spend_2024_q2", "transactions_2024_q2", "q2"),
    ("spend_2024_q3", "transactions_2024_q3", "q3"),
    ("spend_2024_q4", "transactions_2024_q4", "q4"),
)
SPEND_COLS = [s for s, _, _ in SPEND_MEASURES]
COUNT_COLS = [c for _, c, _ in SPEND_MEASURES]


def _between(c: Column, bounds: tuple) -> Column:
    return c.between(F.lit(bounds[0]).cast("date"), F.lit(bounds[1]).cast("date"))


def with_signed_amount(tx: DataFrame) -> DataFrame:
    us = "us_equiv_amt" if "us_equiv_amt" in tx.columns else None
    return tx.withColumn("signed_amount", R.signed_amount("transaction_type", "transaction_amt", us))


def period_pivot(tx: DataFrame, periods: Periods = PERIODS, prefilter: bool = False,
                 key: str = "current_account_nbr") -> DataFrame:
    """AGG-04: per account, signed spend and purchase count in six periods.

    ``prefilter`` restricts the scan to the reporting span (pushed down to
    the source); accounts without any transaction in the span then have no
    row, which is equivalent after a left join + sum.
    """
    if prefilter:
        lo, hi = periods.span()
        tx = tx.filter(_between(F.col("transaction_date"), (lo, hi)))
    return with_signed_amount(tx).groupBy(key).agg(*pivot_measures(periods))


def pivot_measures(periods: Periods) -> list[Column]:
    """The twelve conditional aggregates over signed transactions."""
    d, purchase = F.col("transaction_date"), F.col("transaction_type") == "SALE"
    aggs = []
    for spend, cnt, attr in SPEND_MEASURES:
        in_p = _between(d, getattr(periods, attr))
        aggs.append(F.coalesce(F.sum(F.when(in_p, F.col("signed_amount"))), F.lit(0)).alias(spend))
        aggs.append(F.count_if(in_p & purchase).alias(cnt))
    return aggs


def fraud_tran_by_account(ft: DataFrame) -> DataFrame:
    """AGG-05: count / sum / mean / max / min of fraud amounts and distinct
    cases per account (mean as exact sum / count)."""
    amt = F.col("transaction_am")
    return ft.groupBy("current_account_nbr").agg(
        F.count(amt).alias("fraud_transaction_count"),
        F.sum(amt).alias("fraud_transaction_sum"),
        (F.sum(amt).cast("double") / F.count(amt)).alias("fraud_transaction_avg"),
        F.max(amt).alias("fraud_transaction_max"),
        F.min(amt).alias("fraud_transaction_min"),
        F.count_distinct("case_id").alias("fraud_case_count"),
    )


FRAUD_TX_COLS = ("fraud_transaction_count", "fraud_transaction_sum", "fraud_transaction_avg",
                 "fraud_transaction_max", "fraud_transaction_min", "fraud_case_count")

SNAPSHOT_RENAME = {
    "cu_account_nbr": "current_account_nbr",
    "cu_crd_line": "credit_line",
    "cu_cur_balance": "current_balance",
    "cu_bhv_scr": "behavior_score",
    "cu_crd_bureau_scr": "credit_score",
}


def account_table(t, periods: Periods = PERIODS) -> DataFrame:
    """The account-level merged table (one row per account x snapshot row):
    JOIN-01 inner spine, JOIN-02 left joins to pre-aggregated facts, AGG-06
    fraud flag max per account, JOIN-03 snapshot fan-out, SET-02 / PRJ-08
    payment-history struct expanded next to the existing columns, PRJ-25
    derived columns in one ``withColumns``.  ``t``: ``Tables`` (each driver
    table is scanned once) or ``Sources`` (a scan per source table)."""
    m = _merged_sources(t, periods) if isinstance(t, Sources) else _merged_tables(t, periods)
    m = m.fillna(0, subset=list(FRAUD_TX_COLS))
    for period in ("1_12", "13_24"):
        src = f"payment_hist_{period}_mths"
        m = m.select("*", *R.payment_history_columns(src, f"payment_hist_{period}_")).drop(src)

    ref = F.lit(periods.ref_date).cast("date")
    both = F.col("card_activation_date").isNotNull() & F.col("open_date").isNotNull()
    return m.withColumns({
        "account_age_days": F.datediff(ref, F.col("open_date")),
        "activation_delay_days": F.when(both, F.datediff("card_activation_date", "open_date")),
        "avg_transaction_size_2024": R.guarded_avg("total_spend_2024", "total_transactions_2024"),
        "is_active_account": F.col("closed_date").isNull().cast("int"),
    })


def _account_columns(acc: DataFrame) -> DataFrame:
    return (acc.drop("date_in_collection", "special_finance_charge_ind")
            .withColumn("is_high_income", R.income_from_code("employee_code")).drop("employee_code"))


def _merged_sources(src: Sources, periods: Periods) -> DataFrame:
    """Spine and facts of separate source tables.  Over tables bucketed by
    account no aggregate and no join below needs an exchange."""
    idm = (src.identity_map
           .select(F.col("account_nbr_pty").alias("current_account_nbr"), F.col("ds_id").alias("user_id"))
           .filter(F.col("current_account_nbr").isNotNull() & F.col("user_id").isNotNull()))
    m = _account_columns(src.account_dim).join(idm, "current_account_nbr", "inner")

    stmt = (src.statement_fact.groupBy("current_account_nbr")
            .agg(F.sum("return_check_cnt_total").alias("return_check_cnt_total")))
    m = m.join(stmt, "current_account_nbr", "left")

    m = m.join(period_pivot(src.transactions, periods, prefilter=True), "current_account_nbr", "left")

    cases = src.fraud_claim_case.groupBy("current_account_nbr").agg(F.max(F.lit(1)).alias("has_fraud"))
    m = (m.join(cases, "current_account_nbr", "left")
          .withColumn("has_fraud", F.coalesce("has_fraud", F.lit(0)).cast("int")))

    m = m.join(fraud_tran_by_account(src.fraud_claim_tran), "current_account_nbr", "left")

    snap = src.credit_snapshot.withColumnsRenamed(SNAPSHOT_RENAME)
    return m.join(snap, "current_account_nbr", "left")  # JOIN-03: fan-out kept


def _merged_tables(t, periods: Periods) -> DataFrame:
    """The same over the driver tables, where accounts, identities and
    snapshots are rows of ``orders``, transactions, histories and balances
    come from ``lineitem`` and statements and fraud from ``events``: one
    aggregate per table instead of one per role."""
    lines, events = roles.line_facts(t, periods.span(), with_signed_amount, pivot_measures(periods)), roles.event_facts(t)
    # one row per order: account, identity and snapshot agree on the key, so the spine join is the row itself
    spine = roles.account_rows(t).filter("current_account_nbr is not null and user_id is not null")
    customers = t.customer.select("c_custkey", "c_acctbal")
    # the customer comes first, while rows are narrow
    m = (spine.join(customers, F.col("user_id") == F.col("c_custkey"), "left")
         .join(lines, "current_account_nbr", "left")
         .join(events, "current_account_nbr", "left"))
    return _account_columns(roles.merged_columns(m)).withColumn("has_fraud", F.coalesce("has_fraud", F.lit(0)).cast("int"))


def exact_avg(c: str) -> Column:
    """Mean of a DOUBLE column with an order-independent DECIMAL(38,9) sum."""
    return F.sum(F.col(c).cast("decimal(38,9)")).cast("double") / F.count(c)


def _present(df: DataFrame, cols) -> list:
    return [c for c in cols if c in df.columns]


def user_rollup(acct: DataFrame) -> DataFrame:
    """AGG-07: dictionary-driven user rollup over the columns that exist.
    Accounts of a user lie apart, so sums before the exchange would be as many
    and wider: accounts are dealt by user, then added."""
    aggs = []
    for c in _present(acct, SPEND_COLS + COUNT_COLS + ["credit_line", "current_balance"]):
        aggs.append(F.coalesce(F.sum(c), F.lit(0)).alias(c))
    for c in _present(acct, ["behavior_score", "credit_score"]):
        aggs.append(F.min(c).alias(c))
    # Flag columns rolled up with max when present
    flag_cols = ["delinquency_12mo", "delinquency_24mo", "sent_to_collection", "ever_overlimit",
                 "has_unactivated_card", "uses_ebill", "is_high_income", "high_spender",
                 "has_pscc_account", "has_external_status", "has_fraud"]
    for c in _present(acct, flag_cols):
        aggs.append(F.max(c).alias(c))
    for c in _present(acct, ["fraud_transaction_count", "fraud_transaction_sum", "fraud_case_count"]):
        aggs.append(F.coalesce(F.sum(c), F.lit(0)).alias(c))
    # the reference rolls the per-account minimum up with max as well
    for c in _present(acct, ["fraud_transaction_max", "fraud_transaction_min"]):
        aggs.append(F.max(c).alias(c))
    # means of DOUBLE measures: exact (DECIMAL) accumulation, so the result
    # does not depend on how rows are split across tasks
    for c in _present(acct, ["fraud_transaction_avg"]):
        aggs.append(exact_avg(c).alias(c))
    for period in ("1_12", "13_24"):
        for m in R.PAYMENT_METRICS:
            c = f"payment_hist_{period}_{m}"
            if c in acct.columns:
                aggs.append(F.max(c).alias(c))
    for c in _present(acct, ["account_age_days", "activation_delay_days"]):
        aggs.append(F.avg(c).alias(c))
    for c in _present(acct, ["avg_transaction_size_2024"]):
        aggs.append(exact_avg(c).alias(c))
    aggs.append(F.coalesce(F.sum("is_active_account"), F.lit(0)).alias("active_account_count"))
    return acct.filter(F.col("user_id").isNotNull()).repartition("user_id").groupBy("user_id").agg(*aggs)


def accounts_per_user(t) -> DataFrame:
    """AGG-02: distinct accounts per user from the identity map."""
    return (as_sources(t).identity_map.filter(F.col("ds_id").isNotNull())
            .groupBy(F.col("ds_id").alias("user_id"))
            .agg(F.count_distinct("account_nbr_pty").alias("num_accounts")))


def finish_user(users: DataFrame, counts: DataFrame) -> DataFrame:
    """JOIN-08 + RUL-24 + RUL-03 + MTH-09: account counts, activity flag,
    utilisation and monthly spend; money cast to DOUBLE from here on."""
    money = [c for c in users.columns if isinstance(users.schema[c].dataType, DecimalType)]
    u = users.withColumns({c: F.col(c).cast("double") for c in money})
    u = u.join(counts, "user_id", "left")
    return u.withColumns({
        "user_active_flag": (F.col("active_account_count") > 0).cast("int"),
        "utilization_pct": R.guarded_pct("current_balance", "credit_line"),
        "avg_monthly_spend_2024": F.col("total_spend_2024") / 12.0,
    })


# Name patterns imputed with 0 instead of the median
ZERO_PREFIXES = ("total_", "count_", "num_")
ZERO_SUFFIXES = ("_count", "_flag")


def impute_by_name(df: DataFrame, key: str = "user_id",
                   zero_prefixes=ZERO_PREFIXES, zero_suffixes=ZERO_SUFFIXES) -> DataFrame:
    """PRJ-22 + PRJ-23: +-inf -> missing; name-driven fill (0 for count-like
    names, median for the rest).  Medians are computed only for columns that
    actually hold missing values (one null-count pass first)."""
    from pyspark.sql.types import NumericType, FloatType, DoubleType
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != key]
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}
    df = df.withColumns({c: R.inf_to_null(c) for c in num if c in dbl})
    zero = [c for c in num if c.startswith(zero_prefixes) or c.endswith(zero_suffixes)]
    rest = [c for c in num if c not in zero]
    if rest:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rest]).first().asDict()
        need = [c for c in rest if nulls[c]]
    else:
        need = []
    med = {}
    if need:
        from creditlens.operators.quantiles import exact_medians
        med = exact_medians(df, need)
    cols = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in zero}
    # median-filled columns are DOUBLE (a median of integers may be fractional)
    for c in rest:
        v = med.get(c)
        cols[c] = F.col(c).cast("double") if v is None else F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
    return df.withColumns(cols)


def scale_thousands(df: DataFrame, cols=("credit_line", "current_balance")) -> DataFrame:
    """PRJ-24."""
    return df.withColumns({c: F.col(c) / 1000 for c in cols if c in df.columns})


def add_master_labels(u: DataFrame, seed=42) -> DataFrame:
    """RUL-04 (>0), RUL-05 + SMP-03 (8 %), RUL-09 + SMP-04(a), RUL-12."""
    from creditlens.operators import sampling as S
    u = u.withColumns({
        "delinquency_12mo": R.delinquency_flag("payment_hist_1_12_delinquency_count", 0),
        "delinquency_24mo": R.delinquency_flag("payment_hist_13_24_delinquency_count", 0),
    })
    u = u.withColumn("risk_flag", R.risk_rule_a("payment_hist_1_12_delinquency_count",
                                                "payment_hist_13_24_delinquency_count",
                                                "utilization_pct", "credit_score"))
    u = S.flag_top_up(u, "risk_flag", ["user_id"], 0.08, seed)
    u = u.withColumn("segment_label", R.segment_a("utilization_pct", "credit_score", "risk_flag"))
    u = S.fill_empty_segments(u, "segment_label", ["user_id"], seed)
    return u.withColumn("risk_probability",
                        R.risk_probability_proxy("risk_flag", "credit_score", "utilization_pct", "user_id"))


def user_master(t, periods: Periods = PERIODS,
                checkpoint: bool = True) -> DataFrame:
    """The full master build: one row per user with spend, credit, fraud,
    history, derived measures and rule labels."""
    # Tables (role views) or Sources (e.g. CSV extracts)
    users = finish_user(user_rollup(account_table(t, periods)), accounts_per_user(t))
    if checkpoint:
        # several small actions follow (null counts, medians, quota counts);
        # cut the lineage once so they do not recompute the rollup
        users = users.checkpoint(eager=True)
    users = scale_thousands(impute_by_name(users))
    return add_master_labels(users)

"""Queries over the source layer: bucketed accounts, nested rows, as-of joins on
timestamps, types and rejects of CSV text, profiles gathered while writing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.operators import clean as C
from creditlens.operators import entities, reports
from creditlens.operators.asof import asof_join
from creditlens.plans import q_core
from creditlens.plans.registry import query, session_key
from creditlens.session import checkpoint_dir
from creditlens.sources import buckets, io, roles
from creditlens.sources.extracts import Sources
from creditlens.sources.roles import with_roles
from creditlens.sources.tables import Tables

_BUCKETED: dict = {}

#: Buckets of the registered query; a deployment chooses files of about 256 MB.
QUERY_BUCKETS = 16


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bucketed_view(spark, sf_dir) -> Sources:
    """The account sources, written once per session as bucketed tables."""
    key = session_key(spark, sf_dir)
    if key not in _BUCKETED:
        _BUCKETED[key] = buckets.bucket_sources(Sources.from_tables(Tables(spark, sf_dir)), QUERY_BUCKETS)
    return _BUCKETED[key]


@query("account_features_bucketed", q_core._acct_out_sql)
def account_features_bucketed(spark, sf_dir):
    """SRC-08 + JOIN-01/02/03: the account table over sources bucketed by account."""
    return q_core.account_columns(bucketed_view(spark, sf_dir))


# ------------------------------------------------------- nested account rows

CHUNK = 2
_NESTED = {  # collection -> (role, ordered columns)
    "statement": ("statement_fact", ("billing_cycle_date", "prev_balance", "return_check_cnt_total")),
    "transaction": ("transactions", ("transaction_date", "transaction_amt", "transaction_type", "us_equiv_amt")),
    "fraud_case": ("fraud_claim_case", ("reported_date", "gross_fraud_amt", "case_id", "net_fraud_amt")),
    "fraud_transaction": ("fraud_claim_tran", ("transaction_dt", "transaction_am", "case_id")),
}


def _nested_sql() -> str:
    parts = []
    for kind, (role, cols) in _NESTED.items():
        text = " || '/' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols[:3])
        order = ", ".join(f"{c} NULLS FIRST" for c in cols)
        parts.append(f"""
SELECT current_account_nbr, '{kind}' AS collection, place // {CHUNK} AS chunk, count(*) AS n_rows,
       string_agg(txt, ';' ORDER BY place) AS rows_text
FROM (SELECT current_account_nbr, {text} AS txt,
             row_number() OVER (PARTITION BY current_account_nbr ORDER BY {order}) - 1 AS place FROM {role})
GROUP BY 1, 2, 3""")
    return with_roles(*[r for r, _ in _NESTED.values()]) + " UNION ALL ".join(parts)


def _written(cols):
    return F.transform("rows", lambda r: F.concat_ws("/", *[F.coalesce(r[c].cast("string"), F.lit("")) for c in cols]))


@query("entity_rows", _nested_sql)
def entity_rows(spark, sf_dir):
    """AGG-26 + SRC-11: the rows of each account nested in numbered chunks,
    written as a nested table and read back."""
    out = None
    for kind, chunks in entities.nested_account_rows(Tables(spark, sf_dir), CHUNK).items():
        path = _scratch(spark, f"entity-{kind}")
        io.write_table(chunks, path)
        part = spark.read.parquet(path).select(
            "current_account_nbr", F.lit(kind).alias("collection"), "chunk", F.size("rows").cast("long").alias("n_rows"),
            F.array_join(_written(_NESTED[kind][1][:3]), ";").alias("rows_text"))
        out = part if out is None else out.unionByName(part)
    return out


# -------------------------------------------------------- as-of on timestamps

_QUOTES_SQL = "SELECT user_id % 7 AS market, ts AS quoted_at, max(value) AS quote FROM events WHERE event_type <> 'view' GROUP BY 1, 2"


@query("asof_quotes", f"""
WITH q AS ({_QUOTES_SQL}),
e AS (SELECT event_id, user_id % 9 AS market, ts, value FROM events WHERE event_type = 'view')
SELECT e.event_id, e.market, e.value, CAST(q.quoted_at AS VARCHAR) AS quoted_at, q.quote
FROM e ASOF LEFT JOIN q ON e.market = q.market AND e.ts >= q.quoted_at""")
def asof_quotes(spark, sf_dir):
    """JOIN-10 on timestamps: each view event takes the latest quote of its
    market (the other events; two markets have none)."""
    events = Tables(spark, sf_dir).events
    quotes = (events.where("event_type <> 'view'").groupBy((F.col("user_id") % 7).alias("market"), F.col("ts").alias("quoted_at"))
              .agg(F.max("value").alias("quote")))
    views = events.where("event_type = 'view'").select("event_id", (F.col("user_id") % 9).alias("market"), "ts", "value")
    out = asof_join(views, quotes, "market", "market", "ts", "quoted_at", ["quoted_at", "quote"])
    return out.select("event_id", "market", "value", F.col("quoted_at").cast("string").alias("quoted_at"), "quote")


# ----------------------------------------------------------- types of CSV text

_TYPED = {  # source -> column -> the type its text has
    "account_dim": {"current_account_nbr": "bigint", "open_date": "date", "card_activation_date": "date", "closed_date": "date",
                    "employee_code": "string", "ebill_ind": "string", "pscc_ind": "bigint",
                    "external_status_reason_code": "bigint", "ext_status_reason_cd_desc": "string"},
    "identity_map": {"account_nbr_pty": "bigint", "ds_id": "bigint", "open_date": "date", "closed_date": "date"},
    "statement_fact": {"current_account_nbr": "bigint", "billing_cycle_date": "date", "prev_balance": "decimal(18,2)",
                       "return_check_cnt_total": "bigint", "return_check_cnt_last_mth": "bigint"},
    "fraud_claim_case": {"case_id": "bigint", "reported_date": "date", "gross_fraud_amt": "decimal(18,2)",
                         "reopen_date": "string"},
    "fraud_claim_tran": {"case_id": "bigint", "transaction_am": "decimal(18,2)", "transaction_dt": "date"},
    "credit_snapshot": {"cu_account_nbr": "bigint", "cu_crd_line": "decimal(18,2)", "cu_cur_balance": "decimal(18,4)",
                        "cu_bhv_scr": "bigint", "cu_next_crd_line_rev_date": "date", "cu_rnd_nbr": "string"},
}


@query("csv_types", lambda: with_roles(*_TYPED) + " UNION ALL ".join(
    f"\nSELECT '{s}' AS source, '{c}' AS column_name, '{t}' AS type, count({c}) AS n_values FROM {s}"
    for s, cols in _TYPED.items() for c, t in cols.items()))
def csv_types(spark, sf_dir):
    """SRC-01/02: the sources written as CSV text, their types found again."""
    t, rows = Tables(spark, sf_dir), []
    for source, cols in _TYPED.items():
        path = _scratch(spark, f"csv-{source}")
        io.write_table(getattr(roles, source)(t).select(*cols), path, "csv")
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
        rows += [(source, c, kind, n) for c, kind, n in io.column_types(raw)]
    return spark.createDataFrame(rows, "source string, column_name string, type string, n_values long")


@query("csv_rejects", """
SELECT column_name, type, value, count(*) AS n FROM (
    SELECT 'o_orderdate' AS column_name, 'date' AS type, '1997-13-45' AS value FROM orders WHERE o_orderkey % 77 = 0
    UNION ALL SELECT 'o_totalprice', 'decimal(18,2)', 'n/a' FROM orders WHERE o_orderkey % 50 = 0
    UNION ALL SELECT 'o_custkey', 'bigint', o_orderstatus || CAST(o_custkey % 5 AS VARCHAR) FROM orders WHERE o_orderkey % 31 = 0)
GROUP BY 1, 2, 3""")
def csv_rejects(spark, sf_dir):
    """SRC-01/02: cells that do not have their column's declared type, counted;
    every 50th, 77th and 31st order carries one."""
    key = F.col("o_orderkey")
    text = Tables(spark, sf_dir).orders.select(
        key, F.when(key % 31 == 0, F.concat("o_orderstatus", (F.col("o_custkey") % 5).cast("string")))
        .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(key % 50 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.when(key % 77 == 0, "1997-13-45").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("o_orderdate"))
    path = _scratch(spark, "csv-rejects")
    io.write_table(text, path, "csv")
    _, bad = io.read_csv_checked(spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice decimal(18,2), o_orderdate date")
    return bad.groupBy(F.col("column").alias("column_name"), "type", "value").agg(F.count("*").alias("n"))


# ------------------------------------------------------ profile while writing

_RECIPES = {
    "account_dim": C.clean_account_dim, "statement_fact": C.clean_statement_fact, "identity_map": C.clean_identity_map,
    "transaction_fact_raw": C.clean_transactions, "fraud_claim_case": C.clean_fraud_case,
    "credit_snapshot": C.clean_credit_snapshot,
}
#: Columns whose nulls the recipe changes: the SQL condition of a null after cleaning.
_FILLED = {
    "account_dim": {"is_high_income": "false", "pscc_ind": "false", "ebill_ind": "false", "ext_status_reason_cd_desc": "false"},
    "statement_fact": {}, "fraud_claim_case": {}, "credit_snapshot": {},
    "identity_map": {"closed_date": "false"},
    "transaction_fact_raw": {"invoice_nbr": "false", "fcr_amount": "false", "fcr_rate_of_exchange": "false", "product_qty": "false"},
}
_CLEANED_COLUMNS = {
    "account_dim": ("current_account_nbr client_id open_date card_activation_date closed_date is_high_income ebill_ind pscc_ind "
                    "external_status_reason_code ext_status_reason_cd_desc payment_hist_1_12_mths payment_hist_13_24_mths"),
    "statement_fact": "current_account_nbr user_id billing_cycle_date prev_balance return_check_cnt_total return_check_cnt_last_mth",
    "identity_map": "account_nbr_pty ds_id open_date closed_date",
    "transaction_fact_raw": ("current_account_nbr transaction_date transaction_type transaction_amt posting_date adj_orgn_tran_dt "
                             "invoice_nbr fcr_amount fcr_rate_of_exchange product_qty"),
    "fraud_claim_case": "case_id current_account_nbr reported_date open_date reopen_date close_date gross_fraud_amt net_fraud_amt",
    "credit_snapshot": ("cu_account_nbr cu_crd_line cu_cur_balance cu_bhv_scr cu_crd_bureau_scr cu_next_crd_line_rev_date "
                        "cu_processing_date"),
}


def _profile_sql() -> str:
    parts = [f"\nSELECT '{s}' AS source, '{c}' AS column_name, count(*) AS n_rows, "
             f"count(*) FILTER (WHERE {_FILLED[s].get(c, f'{c} IS NULL')}) AS n_null FROM {s}"
             for s, cols in _CLEANED_COLUMNS.items() for c in cols.split()]
    return with_roles(*_RECIPES) + " UNION ALL ".join(parts)


@query("profile_on_write", _profile_sql)
def profile_on_write(spark, sf_dir):
    """AGG-23 + RUL-25 + SRC-08: each cleaned table is written once as a new
    version; its row and null counts are observed by that same write."""
    t, rows = Tables(spark, sf_dir), []
    for source, recipe in _RECIPES.items():
        counts = reports.write_profiled(recipe(getattr(roles, source)(t)), _scratch(spark, f"clean-{source}"))
        rows += [(source, c, counts["rows"], n) for c, n in counts["nulls"].items()]
    return spark.createDataFrame(rows, "source string, column_name string, n_rows long, n_null long")

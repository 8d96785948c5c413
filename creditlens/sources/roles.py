"""Role views: the card-account source tables expressed over the driver tables.

The driver ships TPC-H-like tables; the analytics in this package are written
against the card-account model (accounts, identity map, statements,
transactions, fraud, credit-line snapshot).  Each function here derives one
source table from the driver tables, lazily, so the whole flow stays one
logical plan.  ``ROLE_SQL`` holds the same definitions as DuckDB/ANSI CTEs
for the oracle queries; the two must stay in step.

Money columns are DECIMAL(18,2) so that sums are exact in both engines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.sources.tables import Tables

MONEY = "decimal(18,2)"

# Fixed values of the role mapping (test-table conventions):
#   payment-history code alphabet, indexed by 1 + l_partkey % 30
HIST_CODES = "AAAAAIIIIIQQZZZ%#+-0AIAIAAIBJ3"
#   lines shipped on/after this date form months 1-12, earlier ones 13-24
HIST_SPLIT = "1998-07-01"


@dataclass(frozen=True)
class Periods:
    """Reporting calendar.  The reference's 2024 / 2025-YTD calendar is mapped
    onto the years present in the test tables; every bound is inclusive."""

    year: tuple = ("1997-01-01", "1997-12-31")
    ytd: tuple = ("1998-01-01", "1998-03-24")
    q1: tuple = ("1997-01-01", "1997-03-31")
    q2: tuple = ("1997-04-01", "1997-06-30")
    q3: tuple = ("1997-07-01", "1997-09-30")
    q4: tuple = ("1997-10-01", "1997-12-31")
    ref_date: str = "1998-03-25"

    def span(self) -> tuple:
        bounds = [self.year, self.ytd, self.q1, self.q2, self.q3, self.q4]
        return min(b[0] for b in bounds), max(b[1] for b in bounds)


PERIODS = Periods()


def _d(s: str) -> Column:
    return F.lit(s).cast("date")


# ---------------------------------------------------------------- accounts

def line_summary(t: Tables) -> DataFrame:
    """Per order: first / last ship date and the two payment-history strings.

    One scan of lineitem.  A history string holds one code (the smallest) per
    calendar month with a line, so it has at most 12 characters however many
    lines an account has.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_shipdate")
    code = F.expr(f"substring('{HIST_CODES}', cast(l_partkey % 30 + 1 as int), 1)")
    period = F.when(F.col("l_shipdate") >= F.lit(HIST_SPLIT).cast("timestamp_ntz"), "1_12").otherwise("13_24")
    monthly = (li.groupBy("l_orderkey", period.alias("period"), F.month("l_shipdate").alias("m"))
               .agg(F.min(code).alias("ch"),
                    F.min("l_shipdate").alias("first_ship"),
                    F.max("l_shipdate").alias("last_ship")))

    def hist(p: str) -> Column:
        pieces = F.collect_list(F.when(F.col("period") == p, F.struct("m", "ch")))
        arr = F.array_sort(pieces)
        return F.when(F.size(arr) > 0, F.array_join(F.transform(arr, lambda x: x["ch"]), ""))

    return (monthly.groupBy("l_orderkey")
            .agg(F.min("first_ship").cast("date").alias("first_ship"),
                 F.max("last_ship").cast("date").alias("last_ship"),
                 hist("1_12").alias("payment_hist_1_12_mths"),
                 hist("13_24").alias("payment_hist_13_24_mths")))


def account_dim(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    ls = line_summary(t)
    return (o.join(ls, o.o_orderkey == ls.l_orderkey, "left")
            .select(
                F.col("o_orderkey").alias("current_account_nbr"),
                F.col("o_orderdate").cast("date").alias("open_date"),
                "payment_hist_1_12_mths", "payment_hist_13_24_mths",
                *[c.alias(n) for n, c in _account_values(F.col("o_custkey"), F.col("first_ship"), F.col("last_ship")).items()],
            ).select("current_account_nbr", "client_id", "open_date", "card_activation_date", "closed_date", "employee_code",
                     "ebill_ind", "pscc_ind", "external_status_reason_code", "ext_status_reason_cd_desc",
                     "payment_hist_1_12_mths", "payment_hist_13_24_mths", "date_in_collection", "special_finance_charge_ind"))


def _account_values(customer: Column, first_ship: Column, last_ship: Column) -> dict[str, Column]:
    """Account columns derived from an order's status, priority and ship dates."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return {
        "client_id": customer,
        "card_activation_date": first_ship,
        "closed_date": F.when(status == "F", last_ship),
        "employee_code": F.when((priority == "1-URGENT") & (status == "P"), "H").when(priority == "2-HIGH", "Y"),
        "ebill_ind": F.when(status == "F", "Y").when(status == "O", "N"),
        "pscc_ind": F.when(priority == "5-LOW", 1).when(priority == "4-NOT SPECIFIED", F.lit(None).cast("int")).otherwise(0),
        "external_status_reason_code": F.when(status == "F", 0).otherwise(customer % 3 + 1).cast("int"),
        "ext_status_reason_cd_desc": F.when(priority == "3-MEDIUM", "Closed by request"),
        "date_in_collection": F.lit(None).cast("string"),
        "special_finance_charge_ind": F.lit(None).cast("string"),
    }


def identity_map(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("account_nbr_pty"),
        F.col("o_custkey").alias("ds_id"),
        F.col("o_orderdate").cast("date").alias("open_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("closed_date"),
    )


# ----------------------------------------------------------- transactions

def _tx_type() -> Column:
    return (F.when(F.col("l_returnflag") == "R", "RETURN")
            .when(F.col("l_returnflag") == "A", "SALE")
            .when(F.col("l_returnflag") == "N", "OTHER"))


def _amt() -> Column:
    return F.col("l_extendedprice").cast(MONEY)


def _us() -> Column:
    return (F.when(F.col("l_linenumber") == 1, F.lit(None))
            .when(F.col("l_linenumber") == 2, F.lit(0))
            .otherwise(_amt() * (F.lit(1) - F.col("l_tax").cast("decimal(4,2)"))))


def _tx_base(li: DataFrame) -> list:
    return [F.col("l_orderkey").alias("current_account_nbr"),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            _tx_type().alias("transaction_type"),
            _amt().alias("transaction_amt")]


def domestic_transactions(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.filter(F.col("l_linestatus") == "F").select(*_tx_base(li))


def foreign_transactions(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.filter(F.col("l_linestatus") == "O").select(*_tx_base(li), _us().alias("us_equiv_amt"))


def transactions(t: Tables) -> DataFrame:
    """Domestic and foreign transactions as one relation (same rows as
    ``domestic.unionByName(foreign, allowMissingColumns=True)``) from a single
    lineitem scan: foreign rows carry ``us_equiv_amt``, domestic rows NULL."""
    li = t.lineitem
    return li.select(*_tx_base(li),
                     F.when(F.col("l_linestatus") == "O", _us()).alias("us_equiv_amt"))


def transaction_fact_raw(t: Tables) -> DataFrame:
    """Transaction extract with the optional columns the cleaning recipe fills."""
    li = t.lineitem
    return li.filter(F.col("l_linestatus") == "F").select(
        *_tx_base(li),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("posting_date"),
        F.when(F.col("l_linenumber") != 4, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("adj_orgn_tran_dt"),
        F.when(F.col("l_linenumber") != 3,
               F.concat(F.lit("INV"), F.col("l_orderkey").cast("string"), F.lit("-"),
                        F.col("l_linenumber").cast("string"))).alias("invoice_nbr"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("fcr_amount"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("fcr_rate_of_exchange"),
        F.col("l_quantity").alias("product_qty"),
    )


# ------------------------------------------------------ statements, fraud

def _event_account() -> Column:
    """Eight successive events belong to one account."""
    return F.expr("event_id div 8")


def statement_fact(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        _event_account().alias("current_account_nbr"),
        F.col("user_id"),
        F.add_months(F.col("ts").cast("date"), (F.col("event_id") % 12).cast("int")).alias("billing_cycle_date"),
        F.col("value").cast(MONEY).alias("prev_balance"),
        (F.col("event_id") % 4).alias("return_check_cnt_total"),
        F.when(F.col("event_id") % 50 == 0, F.lit(99)).otherwise(F.col("event_id") % 3).alias("return_check_cnt_last_mth"),
    )


def _fraud_events(t: Tables) -> DataFrame:
    e = t.events
    return e.filter(F.col("event_type") == "error")


def fraud_claim_tran(t: Tables) -> DataFrame:
    return _fraud_events(t).select(
        F.col("user_id").alias("case_id"),
        _event_account().alias("current_account_nbr"),
        F.col("value").cast(MONEY).alias("transaction_am"),
        F.col("ts").cast("date").alias("transaction_dt"),
    )


def fraud_claim_case(t: Tables) -> DataFrame:
    return _fraud_events(t).select(
        F.col("user_id").alias("case_id"),
        _event_account().alias("current_account_nbr"),
        F.col("ts").cast("date").alias("reported_date"),
        F.col("ts").cast("date").alias("open_date"),
        F.lit(None).cast("date").alias("reopen_date"),
        F.lit(None).cast("date").alias("close_date"),
        F.col("value").cast(MONEY).alias("gross_fraud_amt"),
        (F.col("value").cast(MONEY) * F.lit(0.9).cast("decimal(2,1)")).alias("net_fraud_amt"),
    )


# ------------------------------------------------------ credit-line snapshot

SCORE_EXPR = "300 + 550 * (c_acctbal + 1000) / 11000"


def _scores() -> tuple[Column, Column]:
    """Behaviour and bureau score of a customer."""
    return F.floor(F.expr(SCORE_EXPR)).cast("int"), F.expr(SCORE_EXPR)


def credit_snapshot(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_acctbal")
    open_bal = (t.lineitem.filter(F.col("l_linestatus") == "O")
                .groupBy("l_orderkey")
                .agg(F.sum(F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
                     .alias("bal")))
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(open_bal, o.o_orderkey == open_bal.l_orderkey, "left")
            .select(
                F.col("o_orderkey").alias("cu_account_nbr"),
                F.col("o_totalprice").cast(MONEY).alias("cu_crd_line"),
                F.coalesce(F.col("bal"), F.lit(0)).cast("decimal(38,4)").alias("cu_cur_balance"),
                *[c.alias(n) for n, c in zip(("cu_bhv_scr", "cu_crd_bureau_scr"), _scores())],
                F.date_add(F.col("o_orderdate").cast("date"), 365).alias("cu_next_crd_line_rev_date"),
                F.col("o_orderdate").cast("date").alias("cu_processing_date"),
                F.lit(None).cast("string").alias("cu_rnd_nbr"),
            ))


# ------------------------------------------- one pass per driver table
#
# The role views above each scan their driver table.  Where several roles of
# one table are needed per account, these give them from a single scan and a
# single exchange.

#: The history codes in the order in which the smallest of a month is taken.
_CODES = "".join(sorted(set(HIST_CODES)))
#: Months whose sets of codes share one BIGINT, a bit per code.
_MONTHS_A_LONG = 63 // len(_CODES)
#: BIGINTs of a period: twelve months, and lines without one.
_LONGS = -(-13 // _MONTHS_A_LONG)


def _history_slot() -> Column:
    """Months of the newer period from 0; of the older one, in BIGINTs of its own, after a slot for no month."""
    newer = F.col("l_shipdate") >= F.lit(HIST_SPLIT).cast("timestamp_ntz")
    return (F.when(newer, F.month("l_shipdate") - 1)
            .otherwise(_LONGS * _MONTHS_A_LONG + F.coalesce(F.month("l_shipdate"), F.lit(0))))


def line_facts(t: Tables, span: tuple, signed, measures: list[Column]) -> DataFrame:
    """Per account with a line: ship dates, history strings, the transaction
    ``measures`` (NULL without a transaction in ``span``) and the open balance.
    ``signed`` adds the signed amount to transactions.

    The codes of a month are a set of bits, and a few BIGINTs hold all months
    of an account, so the histories need no rows of their own.  A line is far
    narrower than an account's sums, and a task's share of a file holds any
    number of accounts, so lines are dealt by account before they are added."""
    li = (t.lineitem.select("l_orderkey", "l_partkey", "l_shipdate", "l_returnflag", "l_linestatus", "l_linenumber",
                            "l_extendedprice", "l_discount", "l_tax")
          .where("l_orderkey is not null").repartition("l_orderkey"))
    code = F.instr(F.lit(_CODES), F.expr(f"substring('{HIST_CODES}', cast(l_partkey % 30 + 1 as int), 1)")) - 1
    open_line = F.col("l_linestatus") == "O"
    slot = _history_slot()
    rows = signed(li.select(
        *_tx_base(li), F.when(open_line, _us()).alias("us_equiv_amt"), "l_shipdate",
        F.floor(slot / _MONTHS_A_LONG).alias("_long"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (slot % _MONTHS_A_LONG * len(_CODES) + code).cast("int")).alias("_bit"),
        F.when(open_line, _amt() * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("open_amt")))
    inside = F.col("transaction_date").between(*(F.lit(d).cast("date") for d in span))
    facts = rows.groupBy("current_account_nbr").agg(
        F.min("l_shipdate").cast("date").alias("first_ship"), F.max("l_shipdate").cast("date").alias("last_ship"),
        F.sum("open_amt").alias("bal"), F.count_if(inside).alias("_inside"), *measures,
        *[F.bit_or(F.when(F.col("_long") == k, F.col("_bit"))).alias(f"_h{k}") for k in range(2 * _LONGS)])

    def months(bits: Column) -> Column:
        """The smallest code of each month of a BIGINT; nothing for a month without one."""
        sets = [F.shiftright(bits, k * len(_CODES)).bitwiseAND(F.lit(2 ** len(_CODES) - 1)) for k in range(_MONTHS_A_LONG)]
        return F.concat_ws("", *[F.substring(F.lit(_CODES), F.bit_count(x.bitwiseAND(-x) - 1) + 1, F.lit(1)) for x in sets])

    def history(first: int) -> Column:
        # one lambda for all: written out per month, the generated method is too long for the JVM to compile
        text = F.array_join(F.transform(F.array(*[f"_h{first + k}" for k in range(_LONGS)]), months), "")
        return F.when(text != "", text)

    names = [c for c in facts.columns if not c.startswith("_") and c not in ("current_account_nbr", "first_ship", "last_ship", "bal")]
    return facts.select("current_account_nbr", "first_ship", "last_ship", "bal",
                        history(0).alias("payment_hist_1_12_mths"), history(_LONGS).alias("payment_hist_13_24_mths"),
                        *[F.when(F.col("_inside") > 0, F.col(c)).alias(c) for c in names])


def event_facts(t: Tables) -> DataFrame:
    """Per account with an event: statement checks, the fraud flag and the
    fraud measures; events are dealt by account first, as in :func:`line_facts`."""
    error = F.col("event_type") == "error"
    e = t.events.select(_event_account().alias("current_account_nbr"), (F.col("event_id") % 4).alias("checks"),
                        F.when(error, F.col("user_id")).alias("case_id"), F.when(error, F.lit(1)).alias("has_fraud"),
                        F.when(error, F.col("value").cast(MONEY)).alias("amt"))
    return e.where("current_account_nbr is not null").repartition("current_account_nbr").groupBy("current_account_nbr").agg(
        F.sum("checks").alias("return_check_cnt_total"), F.max("has_fraud").alias("has_fraud"),
        F.count("amt").alias("fraud_transaction_count"), F.sum("amt").alias("fraud_transaction_sum"),
        (F.sum("amt").cast("double") / F.count("amt")).alias("fraud_transaction_avg"),
        F.max("amt").alias("fraud_transaction_max"), F.min("amt").alias("fraud_transaction_min"),
        F.count_distinct("case_id").alias("fraud_case_count"))


def account_rows(t: Tables) -> DataFrame:
    """Account, identity and snapshot columns that ``orders`` itself holds."""
    return t.orders.select(
        F.col("o_orderkey").alias("current_account_nbr"), F.col("o_custkey").alias("user_id"), "o_orderstatus",
        "o_orderpriority", F.col("o_orderdate").cast("date").alias("open_date"), F.col("o_totalprice").cast(MONEY).alias("credit_line"))


def merged_columns(m: DataFrame) -> DataFrame:
    """:func:`account_rows` with line facts, event facts and the customer -> the
    columns of account dimension, identity map and snapshot in one row."""
    own = ("o_orderstatus", "o_orderpriority", "first_ship", "last_ship", "bal", "c_custkey", "c_acctbal")
    return m.select(
        *[c for c in m.columns if c not in own],
        *[c.alias(n) for n, c in _account_values(F.col("user_id"), F.col("first_ship"), F.col("last_ship")).items()],
        F.coalesce(F.col("bal"), F.lit(0)).cast("decimal(38,4)").alias("current_balance"),
        *[c.alias(n) for n, c in zip(("behavior_score", "credit_score"), _scores())],
        F.date_add("open_date", 365).alias("cu_next_crd_line_rev_date"), F.col("open_date").alias("cu_processing_date"),
        F.lit(None).cast("string").alias("cu_rnd_nbr"))


# ------------------------------------------------------------- FX

def currency_codes(t: Tables) -> DataFrame:
    """numeric code -> alphabetic code.  Nation key is the numeric code (the
    United States use the ISO numeric 840); the alphabetic code is the first
    two letters of the name plus a letter from the key (unique per nation)."""
    n = t.nation
    return n.select(
        F.when(F.col("n_name") == "UNITED STATES", F.lit(840)).otherwise(F.col("n_nationkey")).alias("numeric_code"),
        F.concat(F.upper(F.substring("n_name", 1, 2)), F.expr("chr(65 + n_nationkey)")).alias("alphabetic_code"))


def fx_rates(t: Tables) -> DataFrame:
    """SRC-07 exchange-rate history: rate per (currency, month start) =
    1 + mean tax of that nation's lines."""
    li = t.lineitem.select("l_suppkey", "l_shipdate", "l_tax")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    cc = currency_codes(t)
    g = (li.join(s, li.l_suppkey == s.s_suppkey)
         .groupBy(F.col("s_nationkey"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("rate_date"))
         .agg((F.lit(1.0) + F.sum(F.col("l_tax").cast("decimal(4,2)")).cast("double") / F.count("*")).alias("open")))
    return (g.join(cc, g.s_nationkey == cc.numeric_code)
            .select(F.col("alphabetic_code").alias("currency"), "rate_date", "open"))


def foreign_with_currency(t: Tables) -> DataFrame:
    """Foreign transactions carrying the supplier nation's numeric currency code."""
    li = t.lineitem.filter(F.col("l_linestatus") == "O")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    sn = s.join(n, s.s_nationkey == n.n_nationkey)
    code = F.when(F.col("n_name") == "UNITED STATES", F.lit(840)).otherwise(F.col("s_nationkey"))
    return (li.join(sn, li.l_suppkey == sn.s_suppkey)
            .select(*_tx_base(li), code.alias("frgn_curr_code")))


# ====================================================================
# Oracle twins (DuckDB SQL).  Same definitions, as CTE bodies.
# ====================================================================

_TYPE_SQL = ("CASE l_returnflag WHEN 'R' THEN 'RETURN' WHEN 'A' THEN 'SALE' "
             "WHEN 'N' THEN 'OTHER' END")
_AMT_SQL = "CAST(l_extendedprice AS DECIMAL(18,2))"
_US_SQL = (f"CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 0 "
           f"ELSE {_AMT_SQL} * (1 - CAST(l_tax AS DECIMAL(4,2))) END")
_TX_BASE_SQL = (f"l_orderkey AS current_account_nbr, CAST(l_shipdate AS DATE) AS transaction_date, "
                f"{_TYPE_SQL} AS transaction_type, {_AMT_SQL} AS transaction_amt")

ROLE_SQL = {
    "line_codes": f"""
        SELECT l_orderkey,
               CASE WHEN l_shipdate >= TIMESTAMP '{HIST_SPLIT}' THEN '1_12' ELSE '13_24' END AS period,
               month(l_shipdate) AS m, min(substr('{HIST_CODES}', CAST(l_partkey % 30 + 1 AS INTEGER), 1)) AS ch,
               min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY 1, 2, 3""",
    "line_summary": """
        SELECT l_orderkey,
               CAST(min(first_ship) AS DATE) AS first_ship,
               CAST(max(last_ship) AS DATE) AS last_ship,
               string_agg(CASE WHEN period = '1_12' THEN ch END, '' ORDER BY m)
                   AS payment_hist_1_12_mths,
               string_agg(CASE WHEN period = '13_24' THEN ch END, '' ORDER BY m)
                   AS payment_hist_13_24_mths
        FROM line_codes GROUP BY 1""",
    "account_dim": """
        SELECT o_orderkey AS current_account_nbr, o_custkey AS client_id,
               CAST(o_orderdate AS DATE) AS open_date,
               ls.first_ship AS card_activation_date,
               CASE WHEN o_orderstatus = 'F' THEN ls.last_ship END AS closed_date,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'H'
                    WHEN o_orderpriority = '2-HIGH' THEN 'Y' END AS employee_code,
               CASE WHEN o_orderstatus = 'F' THEN 'Y' WHEN o_orderstatus = 'O' THEN 'N' END AS ebill_ind,
               CASE WHEN o_orderpriority = '5-LOW' THEN 1
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 0 END AS pscc_ind,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 3 + 1 END AS INTEGER)
                   AS external_status_reason_code,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Closed by request' END AS ext_status_reason_cd_desc,
               ls.payment_hist_1_12_mths, ls.payment_hist_13_24_mths,
               CAST(NULL AS VARCHAR) AS date_in_collection,
               CAST(NULL AS VARCHAR) AS special_finance_charge_ind
        FROM orders LEFT JOIN line_summary ls ON ls.l_orderkey = o_orderkey""",
    "identity_map": """
        SELECT o_orderkey AS account_nbr_pty, o_custkey AS ds_id, CAST(o_orderdate AS DATE) AS open_date,
               CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS closed_date
        FROM orders""",
    "domestic_transactions": f"SELECT {_TX_BASE_SQL} FROM lineitem WHERE l_linestatus = 'F'",
    "foreign_transactions": f"SELECT {_TX_BASE_SQL}, {_US_SQL} AS us_equiv_amt FROM lineitem WHERE l_linestatus = 'O'",
    "transactions": f"""SELECT {_TX_BASE_SQL},
               CASE WHEN l_linestatus = 'O' THEN {_US_SQL} END AS us_equiv_amt FROM lineitem""",
    "transaction_fact_raw": f"""
        SELECT {_TX_BASE_SQL},
               strftime(l_shipdate, '%Y-%m-%d') AS posting_date,
               CASE WHEN l_linenumber <> 4 THEN strftime(l_shipdate, '%Y-%m-%d') END AS adj_orgn_tran_dt,
               CASE WHEN l_linenumber <> 3 THEN 'INV' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END
                   AS invoice_nbr,
               CASE WHEN l_discount > 0 THEN l_discount END AS fcr_amount,
               CASE WHEN l_tax > 0 THEN l_tax END AS fcr_rate_of_exchange,
               l_quantity AS product_qty
        FROM lineitem WHERE l_linestatus = 'F'""",
    "statement_fact": """
        SELECT event_id // 8 AS current_account_nbr, user_id,
               CAST(CAST(ts AS DATE) + to_months(CAST(event_id % 12 AS INTEGER)) AS DATE) AS billing_cycle_date,
               CAST(value AS DECIMAL(18,2)) AS prev_balance, event_id % 4 AS return_check_cnt_total,
               CASE WHEN event_id % 50 = 0 THEN 99 ELSE event_id % 3 END AS return_check_cnt_last_mth
        FROM events""",
    "fraud_claim_tran": """
        SELECT user_id AS case_id, event_id // 8 AS current_account_nbr,
               CAST(value AS DECIMAL(18,2)) AS transaction_am, CAST(ts AS DATE) AS transaction_dt
        FROM events WHERE event_type = 'error'""",
    "fraud_claim_case": """
        SELECT user_id AS case_id, event_id // 8 AS current_account_nbr,
               CAST(ts AS DATE) AS reported_date, CAST(ts AS DATE) AS open_date,
               CAST(NULL AS DATE) AS reopen_date, CAST(NULL AS DATE) AS close_date,
               CAST(value AS DECIMAL(18,2)) AS gross_fraud_amt,
               CAST(value AS DECIMAL(18,2)) * CAST(0.9 AS DECIMAL(2,1)) AS net_fraud_amt
        FROM events WHERE event_type = 'error'""",
    "open_balance": """
        SELECT l_orderkey,
               sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS bal
        FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1""",
    "credit_snapshot": f"""
        SELECT o_orderkey AS cu_account_nbr, CAST(o_totalprice AS DECIMAL(18,2)) AS cu_crd_line,
               CAST(coalesce(ob.bal, 0) AS DECIMAL(38,4)) AS cu_cur_balance,
               CAST(floor({SCORE_EXPR}) AS INTEGER) AS cu_bhv_scr,
               {SCORE_EXPR} AS cu_crd_bureau_scr,
               CAST(o_orderdate AS DATE) + 365 AS cu_next_crd_line_rev_date,
               CAST(o_orderdate AS DATE) AS cu_processing_date,
               CAST(NULL AS VARCHAR) AS cu_rnd_nbr
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
             LEFT JOIN open_balance ob ON ob.l_orderkey = o_orderkey""",
    "currency_codes": """
        SELECT CASE WHEN n_name = 'UNITED STATES' THEN 840 ELSE n_nationkey END AS numeric_code,
               upper(substr(n_name, 1, 2)) || chr(65 + n_nationkey) AS alphabetic_code FROM nation""",
    "fx_rates": """
        SELECT cc.alphabetic_code AS currency, g.rate_date, g.open FROM (
            SELECT s_nationkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS rate_date,
                   1.0 + CAST(sum(CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) / count(*) AS open
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) g
        JOIN currency_codes cc ON g.s_nationkey = cc.numeric_code""",
    "foreign_with_currency": f"""
        SELECT {_TX_BASE_SQL}, CASE WHEN n_name = 'UNITED STATES' THEN 840 ELSE s_nationkey END AS frgn_curr_code
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        WHERE l_linestatus = 'O'""",
}

# dependencies between the CTEs above (emitted in this order)
_ROLE_DEPS = {
    "line_summary": ["line_codes"],
    "account_dim": ["line_codes", "line_summary"],
    "credit_snapshot": ["open_balance"],
    "fx_rates": ["currency_codes"],
}


def with_roles(*names: str) -> str:
    """``WITH`` prefix holding the listed role CTEs (and their dependencies)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _ROLE_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({ROLE_SQL[n]})" for n in order)

"""Cleaning recipes per source table (RUL-25): fixed compositions of the
projection, fill, recode and date operators.  Each takes the raw extract
and returns the cleaned DataFrame; all steps are column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from creditlens.functions import rules as R

# Fixed value: the escaped-quote cell the account extract carries
ESCAPED_QUOTE_CELL = '\\\\\\""'
TX_ZERO_FILL = ["fcr_flag", "fcr_amount", "product_qty", "payment_type", "fcr_rate_of_exchange", "product_amt"]


def lenient_date(c) -> Column:
    """DAT-01: text -> DATE, unparseable -> NULL (never an error)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit("yyyy-MM-dd")))


def as_bool(c) -> Column:
    """PRJ-13 with pandas ``astype(bool)`` semantics: missing -> True,
    numbers -> value != 0, text -> non-empty."""
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    return (F.when(c.isNull(), F.lit(True))
            .when(F.typeof(c) == "string", text != "")
            .when(F.typeof(c) == "boolean", text == "true")
            .otherwise(text.try_cast("double") != 0))


def status_description(desc, code) -> Column:
    """PRJ-10: missing description -> 'Normal' for code 0, 'Other' otherwise."""
    d, k = F.col(desc), F.col(code)
    return (F.when(d.isNull() & R.is_true(k == 0), F.lit("Normal"))
            .when(d.isNull() & R.is_not(k == 0), F.lit("Other")).otherwise(d))


def replace_cells(df: DataFrame, old: str, new: str) -> DataFrame:
    """PRJ-17: whole-cell literal replacement on string columns."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.replace(old, new, subset=strings) if strings else df


def clean_account_dim(acc: DataFrame) -> DataFrame:
    df = acc.drop("date_in_collection", "special_finance_charge_ind")
    df = df.withColumnRenamed("employee_code", "is_high_income")
    df = df.withColumn("is_high_income", R.income_from_code("is_high_income"))
    df = replace_cells(df, ESCAPED_QUOTE_CELL, " ")
    df = df.fillna({"ebill_ind": " "})
    df = df.withColumn("ext_status_reason_cd_desc",
                       status_description("ext_status_reason_cd_desc", "external_status_reason_code"))
    return df.withColumns({"is_high_income": as_bool("is_high_income"), "pscc_ind": as_bool("pscc_ind")})


def clean_statement_fact(st: DataFrame) -> DataFrame:
    return st.withColumn("return_check_cnt_last_mth", R.sentinel_recode("return_check_cnt_last_mth", 99, 0))


def clean_identity_map(m: DataFrame) -> DataFrame:
    return m.fillna({"closed_date": "Open"})


def clean_transactions(tx: DataFrame) -> DataFrame:
    zero = [c for c in TX_ZERO_FILL if c in tx.columns]
    df = tx.fillna(0, subset=zero) if zero else tx
    if "invoice_nbr" in df.columns:
        df = df.fillna({"invoice_nbr": "No Invoice Number"})
    parse = {c: lenient_date(c) for c in ("adj_orgn_tran_dt", "posting_date") if c in df.columns}
    return df.withColumns(parse)


def clean_fraud_case(fc: DataFrame) -> DataFrame:
    return fc  # dates arrive typed; the recipe only parses them


def clean_credit_snapshot(cs: DataFrame) -> DataFrame:
    return cs.drop("cu_rnd_nbr")

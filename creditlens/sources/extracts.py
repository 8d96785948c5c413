"""The card-account sources as one object, from the driver tables or from
real CSV extracts.

``Sources.from_tables`` builds them from the driver tables (role views);
``Sources.from_extracts`` reads the eight CSV extracts with declared schemas
(SRC-01/02/03): the foreign-transaction extract is taken from the first
available of a cleaned and a raw file (SRC-05), and when it carries no
``us_equiv_amt`` the USD amounts are joined from the side table on
(account, date, amount) (JOIN-04).  Every operator of the master build reads
a ``Sources``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.sources import io, roles
from creditlens.sources.tables import Tables


def schemas(key: str = "string") -> dict:
    """Declared extract schemas (types are ours; money is DECIMAL so sums are
    exact, balances and converted amounts keep 4 decimals)."""
    return {
        "account_dim": f"current_account_nbr {key}, client_id {key}, open_date date, card_activation_date date, "
                       "closed_date date, employee_code string, ebill_ind string, pscc_ind int, "
                       "external_status_reason_code int, ext_status_reason_cd_desc string, "
                       "payment_hist_1_12_mths string, payment_hist_13_24_mths string, date_in_collection string, "
                       "special_finance_charge_ind string",
        "identity_map": f"account_nbr_pty {key}, ds_id {key}, open_date date, closed_date string",
        "statement_fact": f"current_account_nbr {key}, user_id {key}, billing_cycle_date date, "
                          "prev_balance decimal(18,2), return_check_cnt_total bigint, return_check_cnt_last_mth bigint",
        "transaction_fact": f"current_account_nbr {key}, transaction_date date, transaction_type string, "
                            "transaction_amt decimal(18,2)",
        "foreign_transaction_fact": f"current_account_nbr {key}, transaction_date date, transaction_type string, "
                                    "transaction_amt decimal(18,2), us_equiv_amt decimal(38,4)",
        "us_equiv_amt": f"current_account_nbr {key}, transaction_date date, transaction_amt decimal(18,2), "
                        "us_equiv_amt decimal(38,4)",
        "fraud_claim_case": f"case_id {key}, current_account_nbr {key}, reported_date date, open_date date, "
                            "reopen_date date, close_date date, gross_fraud_amt decimal(18,2), "
                            "net_fraud_amt decimal(38,4)",
        "fraud_claim_tran": f"case_id {key}, current_account_nbr {key}, transaction_am decimal(18,2), "
                            "transaction_dt date",
        "credit_snapshot": f"cu_account_nbr {key}, cu_crd_line decimal(18,2), cu_cur_balance decimal(38,4), "
                           "cu_bhv_scr int, cu_crd_bureau_scr double, cu_next_crd_line_rev_date date, "
                           "cu_processing_date date, cu_rnd_nbr string",
    }


@dataclass
class Sources:
    account_dim: DataFrame
    identity_map: DataFrame
    statement_fact: DataFrame
    transactions: DataFrame          # domestic + foreign, union by name
    fraud_claim_case: DataFrame
    fraud_claim_tran: DataFrame
    credit_snapshot: DataFrame
    origin: str = "tables"

    @classmethod
    def from_tables(cls, t: Tables) -> "Sources":
        return cls(roles.account_dim(t), roles.identity_map(t), roles.statement_fact(t), roles.transactions(t),
                   roles.fraud_claim_case(t), roles.fraud_claim_tran(t), roles.credit_snapshot(t))

    @classmethod
    def from_extracts(cls, spark: SparkSession, folder: str, key: str = "string",
                      files: dict | None = None) -> "Sources":
        """Read the extracts from ``folder`` (file / folder names overridable
        through ``files``)."""
        sch = schemas(key)
        names = {n: f"{n}.csv" for n in sch}
        names["foreign_transaction_fact"] = ["cleaned_foreign_transaction_fact.csv", "foreign_transaction_fact.csv"]
        names.update(files or {})

        def read(n):
            return io.read_csv(spark, os.path.join(folder, names[n]), sch[n])

        cands = names["foreign_transaction_fact"]
        cands = [cands] if isinstance(cands, str) else cands
        foreign, used = io.first_available(spark, [os.path.join(folder, c) for c in cands],
                                           sch["foreign_transaction_fact"])
        side = os.path.join(folder, names["us_equiv_amt"])
        if foreign.filter(F.col("us_equiv_amt").isNotNull()).limit(1).count() == 0 and io._exists(spark, side):
            keys = ["current_account_nbr", "transaction_date", "transaction_amt"]
            foreign = foreign.drop("us_equiv_amt").join(read("us_equiv_amt"), keys, "left")
        tx = read("transaction_fact").unionByName(foreign, allowMissingColumns=True)
        return cls(read("account_dim"), read("identity_map"), read("statement_fact"), tx,
                   read("fraud_claim_case"), read("fraud_claim_tran"), read("credit_snapshot"), origin=used)

    def write_extracts(self, folder: str) -> None:
        """SRC-08: write every source as a CSV extract (used by the tests)."""
        tx = self.transactions
        io.write_table(tx.filter(F.col("us_equiv_amt").isNull()).drop("us_equiv_amt"),
                       os.path.join(folder, "transaction_fact.csv"), "csv")
        io.write_table(tx.filter(F.col("us_equiv_amt").isNotNull()),
                       os.path.join(folder, "foreign_transaction_fact.csv"), "csv")
        for n in ("account_dim", "identity_map", "statement_fact", "fraud_claim_case", "fraud_claim_tran",
                  "credit_snapshot"):
            io.write_table(getattr(self, n), os.path.join(folder, f"{n}.csv"), "csv")


def as_sources(src) -> Sources:
    return src if isinstance(src, Sources) else Sources.from_tables(src)

"""Skew: one account holds a third of all transactions and one user a third of
all accounts.  The master build must give the same totals as a brute-force
computation (partial aggregation absorbs the hot keys; nothing is capped)."""
import datetime as dt

from pyspark.sql import functions as F

from creditlens.operators.rollup import user_master
from creditlens.sources.extracts import Sources, schemas


def test_hot_account_and_hot_user(spark):
    sch = schemas("bigint")
    n_acc, n_tx = 300, 9000
    acc_user = {a: (0 if a < n_acc // 3 else a % 50 + 1) for a in range(n_acc)}     # user 0: a third of accounts
    day0 = dt.date(1997, 1, 1)
    tx = [(0 if i % 3 == 0 else i % n_acc, day0 + dt.timedelta(days=i % 365),
           "RETURN" if i % 7 == 0 else "SALE", f"{(i % 500) + 0.25:.2f}") for i in range(n_tx)]  # account 0: a third
    s = lambda name, rows: spark.createDataFrame(rows, sch[name])
    accounts = s("account_dim", [(a, acc_user[a], day0, None, None, None, None, 0, 0, None, "A", "A", None, None)
                                 for a in range(n_acc)])
    ident = s("identity_map", [(a, acc_user[a], day0, None) for a in range(n_acc)])
    txs = spark.createDataFrame(tx, "current_account_nbr bigint, transaction_date date, transaction_type string, "
                                    "amt string").select("current_account_nbr", "transaction_date", "transaction_type",
                                                         F.col("amt").cast("decimal(18,2)").alias("transaction_amt"))
    empty = lambda name: spark.createDataFrame([], sch[name])
    snap = s("credit_snapshot", [(a, None, None, 700, 700.0, None, None, None) for a in range(n_acc)])
    snap = snap.withColumn("cu_crd_line", F.lit(1000).cast("decimal(18,2)")) \
               .withColumn("cu_cur_balance", F.lit(100).cast("decimal(38,4)"))
    src = Sources(accounts, ident, empty("statement_fact"), txs, empty("fraud_claim_case"),
                  empty("fraud_claim_tran"), snap)
    got = {r["user_id"]: (r["total_spend_2024"], r["total_transactions_2024"], r["num_accounts"])
           for r in user_master(src).collect()}
    want = {}
    for a, d, t, amt in tx:
        u = acc_user[a]
        sp, n, _ = want.get(u, (0.0, 0, 0))
        v = float(amt) * (-1 if t == "RETURN" else 1)
        want[u] = (sp + v, n + (t == "SALE"), 0)
    for u, (sp, n, _) in want.items():
        assert abs(got[u][0] - sp) < 1e-6 and got[u][1] == n
    assert got[0][2] == n_acc // 3

"""Entity tables (AGG-26).

The reference keeps an in-memory object graph (client -> accounts, account
-> lists of statement / transaction / fraud rows, fraud case -> rows).  On
Spark the related rows stay in their fact tables, keyed by account or case;
the entity table holds one row per entity with the size and key range of
each related collection, built from one aggregate per source and outer
joins on the entity key.  No per-entity array grows with a hot account.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.session import checkpoint_dir
from creditlens.sources import roles
from creditlens.sources.tables import Tables


def account_entities(t: Tables) -> DataFrame:
    k = "current_account_nbr"
    st = roles.statement_fact(t).groupBy(k).agg(F.count("*").alias("n_statements"))
    tx = roles.transactions(t).groupBy(k).agg(
        F.count("*").alias("n_transactions"), F.count("us_equiv_amt").alias("n_foreign"),
        F.min("transaction_date").cast("string").alias("first_tx"),
        F.max("transaction_date").cast("string").alias("last_tx"))
    fc = roles.fraud_claim_case(t).groupBy(k).agg(F.count_distinct("case_id").alias("n_fraud_cases"),
                                                   F.min("case_id").alias("first_case"))
    ft = roles.fraud_claim_tran(t).groupBy(k).agg(F.count("*").alias("n_fraud_transactions"))
    m = roles.identity_map(t).select(F.col("account_nbr_pty").alias(k), F.col("ds_id").alias("user_id"))
    a = roles.account_dim(t).select(k, "client_id")
    e = (a.join(m, k, "left").join(st, k, "left").join(tx, k, "left").join(fc, k, "left").join(ft, k, "left"))
    return e.fillna(0, subset=["n_statements", "n_transactions", "n_foreign", "n_fraud_cases",
                               "n_fraud_transactions"]).select(
        k, "client_id", "user_id", "n_statements", "n_transactions", "n_foreign", "first_tx", "last_tx",
        "n_fraud_cases", "first_case", "n_fraud_transactions")


def fraud_case_entities(t: Tables) -> DataFrame:
    c = roles.fraud_claim_case(t).groupBy("case_id").agg(
        F.count("*").alias("n_claims"), F.count_distinct("current_account_nbr").alias("n_accounts"),
        F.sum("gross_fraud_amt").cast("double").alias("gross_fraud_amt"),
        F.sum("net_fraud_amt").cast("double").alias("net_fraud_amt"),
        F.min("reported_date").cast("string").alias("first_reported"))
    x = roles.fraud_claim_tran(t).groupBy("case_id").agg(
        F.count("*").alias("n_transactions"), F.sum("transaction_am").cast("double").alias("tx_amount"),
        F.max("transaction_dt").cast("string").alias("last_tx"))
    j = c.join(x, "case_id", "full")
    return j.fillna(0, subset=["n_claims", "n_accounts", "n_transactions"]).select(
        "case_id", "n_claims", "n_accounts", "gross_fraud_amt", "net_fraud_amt", "first_reported",
        "n_transactions", "tx_amount", "last_tx")


#: Rows of a chunk.
CHUNK_ROWS = 1000


def chunked(df: DataFrame, key: str, size: int = CHUNK_ROWS, partitions: int | None = None) -> DataFrame:
    """``(key, chunk, rows)``: the rows of each entity in the order of their
    other columns (left to right, NULLs first), ``size`` to a chunk, chunks
    numbered from 0.  Equal rows each stay; rows without a key are one entity.

    Places are counted without gathering an entity: rows are range-partitioned
    by (key, columns), counted inside their partition, and the counts of a
    key's earlier partitions are added.  No task holds more of an entity than
    a partition, no array more than a chunk."""
    spark = df.sparkSession
    cols = [c for c in df.columns if c != key]
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/chunked-{uuid.uuid4().hex}"
    # equal rows may part anywhere: the spread lets a range bound fall between them
    spread = df.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    (spread.repartitionByRange(count, key, *cols, "_spread").withColumn("_part", F.spark_partition_id()).write.parquet(path))
    rows = spark.read.schema(spread.withColumn("_part", F.lit(0)).schema).parquet(path)
    earlier = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    inside = F.row_number().over(Window.partitionBy("_part", key).orderBy(*cols)) - 1
    placed = (rows.withColumn("_at", inside)
              .join(before, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p")))
              .withColumn("_at", F.col("_before") + F.col("_at")))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_at", F.struct(*cols).alias("row")))), lambda x: x["row"])
    return (placed.groupBy(key, F.floor(F.col("_at") / size).alias("chunk")).agg(ordered.alias("rows")))


def flatten_chunks(chunks: DataFrame, key: str, size: int = CHUNK_ROWS) -> DataFrame:
    """Inverse of :func:`chunked`: the rows with ``place``, their number in the entity."""
    one = chunks.select(key, "chunk", F.posexplode("rows").alias("_i", "_row"))
    return one.select(key, (F.col("chunk") * size + F.col("_i")).alias("place"), "_row.*")


def nested_account_rows(t: Tables, size: int = CHUNK_ROWS) -> dict[str, DataFrame]:
    """The four collections of an account as chunks."""
    k = "current_account_nbr"

    def of(df: DataFrame, *cols: str) -> DataFrame:
        return chunked(df.select(k, *cols), k, size)

    return {
        "statement": of(roles.statement_fact(t), "billing_cycle_date", "prev_balance", "return_check_cnt_total"),
        "transaction": of(roles.transactions(t), "transaction_date", "transaction_amt", "transaction_type", "us_equiv_amt"),
        "fraud_case": of(roles.fraud_claim_case(t), "reported_date", "gross_fraud_amt", "case_id", "net_fraud_amt"),
        "fraud_transaction": of(roles.fraud_claim_tran(t), "transaction_dt", "transaction_am", "case_id"),
    }

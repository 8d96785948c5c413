"""Account tables bucketed by account (SRC-08).

A source that several runs join on the account is written once, hashed into
buckets by its account column and sorted inside them.  Aggregates and joins on
the account then start from that layout: no exchange, however large the facts.
"""

from __future__ import annotations

import uuid
from dataclasses import fields, replace

from pyspark.sql import DataFrame

from creditlens.session import checkpoint_dir
from creditlens.sources.extracts import Sources

#: The account column of each source.
ACCOUNT_KEYS = {
    "account_dim": "current_account_nbr", "identity_map": "account_nbr_pty", "statement_fact": "current_account_nbr",
    "transactions": "current_account_nbr", "fraud_claim_case": "current_account_nbr",
    "fraud_claim_tran": "current_account_nbr", "credit_snapshot": "cu_account_nbr",
}


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, folder: str) -> DataFrame:
    """Write ``df`` as table ``name`` under ``folder``, ``buckets`` files hashed
    and sorted by ``key``, and return it."""
    # dealt by the hash that buckets use, so each bucket is one file
    (df.repartition(buckets, key).write.option("path", f"{folder}/{name}").bucketBy(buckets, key).sortBy(key)
     .format("parquet").mode("errorifexists").saveAsTable(name))
    return df.sparkSession.table(name)


def bucket_sources(src: Sources, buckets: int, folder: str | None = None) -> Sources:
    """The same sources, read from bucketed tables in a new folder of the
    shared one.  Every table has the same number of buckets; rows without an
    account share one.  Choose ``buckets`` for files of about 256 MB."""
    spark = src.account_dim.sparkSession
    tag = uuid.uuid4().hex
    folder = f"{(folder or checkpoint_dir(spark)).rstrip('/')}/buckets-{tag}"
    tables = {name: write_bucketed(getattr(src, name), f"{name}_{tag}", key, buckets, folder)
              for name, key in ACCOUNT_KEYS.items()}
    return replace(src, origin=folder, **tables)


def drop_bucketed(src: Sources) -> None:
    """Forget the tables of :func:`bucket_sources` (their files stay in the folder)."""
    spark, tag = src.account_dim.sparkSession, src.origin.rsplit("-", 1)[-1]
    for f in fields(src):
        if f.name in ACCOUNT_KEYS:
            spark.sql(f"DROP TABLE IF EXISTS {f.name}_{tag}")

"""Incremental form of the account spend pivot (Structured Streaming).

The reference processes extracts in batch only; this module runs the same
period pivot (AGG-04 with RUL-01 signed amounts) over a stream of
transaction files: new files are read as they land, each micro-batch is
aggregated to (account -> 12 measures), and the running totals are kept in
Spark's state store (``update`` output mode).  Restarting from the same
checkpoint location resumes exactly where the stream stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.functions import rules as R
from creditlens.operators.rollup import SPEND_MEASURES, _between
from creditlens.sources.roles import PERIODS, Periods


def spend_pivot_stream(transactions: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Streaming period pivot: same measures as ``rollup.period_pivot``;
    ``transactions`` is a streaming DataFrame with the transaction columns."""
    us = "us_equiv_amt" if "us_equiv_amt" in transactions.columns else None
    tx = transactions.withColumn("signed_amount", R.signed_amount("transaction_type", "transaction_amt", us))
    d = F.col("transaction_date")
    purchase = F.col("transaction_type") == "SALE"
    aggs = []
    for spend, cnt, attr in SPEND_MEASURES:
        in_p = _between(d, getattr(periods, attr))
        aggs.append(F.sum(F.when(in_p, F.col("signed_amount")).otherwise(F.lit(0))).alias(spend))
        aggs.append(F.sum(F.when(in_p & purchase, 1).otherwise(0)).cast("long").alias(cnt))
    return tx.groupBy("current_account_nbr").agg(*aggs)


def start_spend_pivot(spark: SparkSession, source_dir: str, schema, sink, checkpoint_location: str,
                      trigger_once: bool = False):
    """Read transaction parquet files from ``source_dir`` as a stream and
    write the running pivot with ``sink(batch_df, batch_id)`` (foreachBatch,
    e.g. a MERGE into a table).  Returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (spend_pivot_stream(stream).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint_location).foreachBatch(sink))
    if trigger_once:
        q = q.trigger(availableNow=True)
    return q.start()

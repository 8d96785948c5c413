"""As-of join on any time resolution (JOIN-10).

Both sides are put into one order of (key, time) by a range partitioning, so a
key with a third of all rows, or a rate history of any length, spreads over
partitions.  Inside a partition the last rate is filled forward; what a
partition needs from before it is the last rate of its first key in the
partitions before, which a small table of (key, partition) ends carries over.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditlens.session import checkpoint_dir


def asof_join(left: DataFrame, right: DataFrame, left_by: str, right_by: str, left_time: str, right_time: str,
              values: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``left`` plus the ``values`` columns of the latest ``right`` row of the
    same key whose time is not after the left row's; NULL where there is none,
    where the key or time is NULL.  Of right rows with equal key and time the
    one with the largest values counts; right rows without key or time are
    ignored.  Left rows are kept as they are, repeated ones too.
    ``partitions``: ranges of the combined rows (default: the session's
    shuffle partitions)."""
    spark = left.sparkSession
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"left has columns {sorted(clash)} already")
    quote = right.where(F.col(right_by).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(right_by).alias("_key"), F.col(right_time).alias("_time"), F.lit(0).alias("_side"),
        F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"), F.struct(*values).alias("_value"))
    rows = left.select(F.col(left_by).alias("_key"), F.col(left_time).alias("_time"), F.lit(1).alias("_side"),
                       F.struct("*").alias("_row"), F.lit(None).cast(quote.schema["_value"].dataType).alias("_value"))
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the row number spreads rows of one key and time, which the sampled range bounds could not part otherwise
    spread = F.when(F.col("_side") == 1, F.xxhash64(F.monotonically_increasing_id())).otherwise(0)
    both = quote.unionByName(rows).withColumn("_spread", spread)
    path = f"{checkpoint_dir(spark).rstrip('/')}/asof-{uuid.uuid4().hex}"
    (both.repartitionByRange(count, "_key", "_time", "_side", "_spread").withColumn("_part", F.spark_partition_id())
     .write.parquet(path))
    both = spark.read.schema(both.withColumn("_part", F.lit(0)).schema).parquet(path)
    # one row per (key, partition): its last quote, and the last one of the partitions before
    ends = both.groupBy("_key", "_part").agg(
        F.max(F.when(F.col("_side") == 0, F.struct("_time", "_value"))).alias("_end"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_key").alias("_k"), F.col("_part").alias("_p"),
                          F.last("_end", ignorenulls=True).over(before)["_value"].alias("_carried"))
    so_far = (Window.partitionBy("_part", "_key").orderBy("_time", "_side", "_value")
              .rowsBetween(Window.unboundedPreceding, 0))
    filled = both.withColumn("_filled", F.last("_value", ignorenulls=True).over(so_far)).where("_side = 1")
    found = F.coalesce("_filled", "_carried")
    return (filled.join(carried, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p")), "left")
            .select("_row.*", *[F.when(F.col("_key").isNotNull() & F.col("_time").isNotNull(), found[v]).alias(v) for v in values]))

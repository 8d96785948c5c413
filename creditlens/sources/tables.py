"""Driver tables (one parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Lazy access to ``{sf_dir}/{name}.parquet``.

    Reading is lazy; Catalyst prunes columns and pushes filters into each
    scan, so callers select only what they need and never pre-load.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def register_views(self) -> None:
        for name in TABLE_NAMES:
            getattr(self, name).createOrReplaceTempView(name)

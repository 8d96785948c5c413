"""Query registry: name -> (Spark callable, oracle SQL).

Each query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is DuckDB SQL
over the driver tables (pre-registered as views).  Queries without an exact
SQL form (model fits) register no oracle.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, Callable[[], str]] = {}


def query(name: str, sql: Callable[[], str] | str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if callable(sql) else (lambda s=sql: s)
        return fn
    return deco


def r6(c) -> Column:
    """Round a float aggregate to 6 decimals with the same IEEE steps in both
    engines (``round`` differs between them on exact ties)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1000000.0 + 0.5) / 1000000.0


def r6s(e: str) -> str:
    return f"(floor(({e}) * 1000000.0 + 0.5) / 1000000.0)"


def sig(c, digits: int = 12) -> Column:
    """Round to ``digits`` significant digits with exact powers of ten only
    (identical IEEE steps in both engines)."""
    c = F.col(c) if isinstance(c, str) else c
    e = F.floor(F.log10(F.abs(c))).cast("int")
    k = F.lit(digits - 1) - e
    up = F.pow(F.lit(10.0), k)          # exact power when k >= 0
    down = F.pow(F.lit(10.0), -k)       # exact power when k < 0
    return (F.when(c.isNull() | (c == 0), c)
            .when(k >= 0, F.floor(c * up + 0.5) / up)
            .otherwise(F.floor(c / down + 0.5) * down))


def sigs(e: str, digits: int = 12) -> str:
    k = f"({digits - 1} - CAST(floor(log10(abs({e}))) AS INTEGER))"
    return (f"(CASE WHEN ({e}) IS NULL OR ({e}) = 0 THEN ({e}) "
            f"WHEN {k} >= 0 THEN floor(({e}) * pow(10.0, {k}) + 0.5) / pow(10.0, {k}) "
            f"ELSE floor(({e}) / pow(10.0, -{k}) + 0.5) * pow(10.0, -{k}) END)")


_USER_CACHE: dict = {}


def session_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Cache key that cannot outlive its session (application id included)."""
    return id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/")


def user_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master user table, built once per session and data folder and kept
    as Parquet in the shared folder, so that readers scan only the columns
    they name."""
    from creditlens.operators.rollup import user_master
    from creditlens.session import checkpoint_dir
    key = session_key(spark, sf_dir)
    if key not in _USER_CACHE:
        path = f"{checkpoint_dir(spark).rstrip('/')}/users-{uuid.uuid4().hex}"
        users = user_master(Tables(spark, sf_dir))
        users.write.parquet(path)
        _USER_CACHE[key] = spark.read.schema(users.schema).parquet(path)
    return _USER_CACHE[key]


def scored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from creditlens.operators.scoring import rule_scores
    return rule_scores(user_view(spark, sf_dir))


def clear_cache() -> None:
    _USER_CACHE.clear()


def load_all() -> None:
    """Import every query module (each registers on import)."""
    from creditlens.plans import q_core, q_reports, q_rules, q_misc, q_sources, q_ml  # noqa: F401

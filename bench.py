"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full
evaluation, nothing collected to the driver).  A short engine warm-up on a
table no headline query reads comes first and is reported as ``warmup_sec``
(not part of ``value``).  The master user build is timed from scratch (fresh
build, its own checkpoint); the queries that read the user table afterwards
reuse it, as a production run would.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "user_master",              # full master build (facts -> accounts -> users -> rules)
    "user_spend_profile",       # flagship summary over the user table
    "period_pivot_by_account",  # union + 12-measure conditional aggregate
    "account_features",         # account-level merged table
    "fx_asof_convert",          # as-of rate join
    "business_days_between",    # calendar + holiday lookups
    "payment_history_features",
    "fraud_comparison",
    "corr_with_target",
    "describe_by_group",
    "segment_rebalance",
    "roc_auc",
    "classification_report",
    "cli_features",
]
MODELS = ["q4_forecast", "q3_backtest", "segment_model", "risk_model", "cli_model"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with_models = os.environ.get("BENCH_MODELS", "1") == "1"
    from creditlens.plans import registry
    from creditlens.session import get_spark
    extra = {"spark.driver.memory": "16g"}
    log_dir = os.environ.get("BENCH_EVENTLOG_DIR")  # optional: stage / task times for later analysis
    if log_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, extra=extra)
    registry.load_all()
    registry.clear_cache()
    # engine warm-up on a table no headline query reads (JVM class loading,
    # code generation); reported separately as warmup_sec, not in ``value``
    t0 = time.time()
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    r = spark.read.parquet(f"{sf_dir}/region.parquet")
    n.join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name").count().collect()
    warmup = round(time.time() - t0, 3)
    times, failed = {}, {}
    names = HEADLINE + ([m for m in MODELS if m in registry.QUERIES] if with_models else [])
    for name in names:
        t0 = time.time()
        try:
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - one failing query must not lose the whole line
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"bench: {name} failed: {failed[name]}", file=sys.stderr)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus), "warmup_sec": warmup}
    if failed:
        out["failed"] = failed
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

"""SparkSession helpers.

The session is configured for the plans in this package: AQE on (runtime
coalescing, skew-join splitting, broadcast of small dimensions discovered at
run time), UTC session time zone, UI off.  A cluster-provided
``spark.checkpoint.dir`` is always respected; a scratch one is only set when
the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # only takes effect when this call starts the JVM (local runs)
    "spark.driver.memory": "8g",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "creditlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session; a scratch
    folder is created only in local mode (tests) when none is set."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            # a machine-local folder is not readable by other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
        d = tempfile.mkdtemp(prefix="creditlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors (once per application,
    also when the stages of a flow begin at the same time: Spark refuses a
    second file of that name)."""
    app = spark.sparkContext.applicationId
    with _SHIPPING:
        if app in _SHIPPED:
            return
        package = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "creditlens_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)

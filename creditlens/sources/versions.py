"""Tables and models that are replaced as a whole (SRC-08, SRC-10).

Every write goes to a new folder ``v-<id>`` beside the earlier ones.  Only
when it is complete does a manifest, a small file with the next number that
must not exist yet, name that folder as the current version.  A write that
dies leaves the old version readable; of two writers with one number the
second fails.  Readers take the manifest with the highest number, so a
version stays readable for those that began with it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _manifests(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """``(number, path)``, ascending."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted((int(n[9:-5]), f"{root}/{n}") for n in names if n.startswith("manifest-") and n.endswith(".json"))


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(b & 0xFF for b in stream.readAllBytes()).decode()
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the current version: ``number``, ``folder`` and ``facts``."""
    found = _manifests(spark, root.rstrip("/"))
    return json.loads(_read_text(spark, found[-1][1])) if found else None


def publish(spark: SparkSession, root: str, write: Callable[[str], None], facts: dict | None = None) -> str:
    """Let ``write(folder)`` fill a new folder under ``root`` and make it the
    current version, noting ``facts`` (read after the write) in its manifest.
    If ``write`` fails, the version before stays current."""
    root = root.rstrip("/")
    number = max((n for n, _ in _manifests(spark, root)), default=0) + 1
    folder = f"{root}/v-{uuid.uuid4().hex}"
    write(folder)
    fs, path = _fs(spark, f"{root}/manifest-{number:06d}.json")
    stream = fs.create(path, False)  # fails where another writer was first
    try:
        stream.write(bytearray(json.dumps({"number": number, "folder": folder, "facts": facts or {}}).encode()))
    finally:
        stream.close()
    return folder


def write_version(df: DataFrame, root: str, facts: dict | None = None) -> str:
    """Replace the table at ``root`` by ``df`` (which may read the old version)."""
    return publish(df.sparkSession, root, lambda folder: df.write.parquet(folder), facts)


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The current version of the table at ``root``."""
    at = current(spark, root)
    if at is None:
        raise FileNotFoundError(f"no version of {root}")
    return spark.read.parquet(at["folder"])

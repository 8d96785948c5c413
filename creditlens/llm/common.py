"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.session import checkpoint_dir

#: ASCII white space; everything else is part of a word (``[^\x20\x09-\x0D]+``).
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RE = "[\\x20\\x09-\\x0D]+"


def word_array(text: Column) -> Column:
    """Words of a text as a native array; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return (F.when(trimmed.isNull() | (trimmed == ""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, BLANK_RE)))


def raw_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes.  ``bytes.split()`` and ``bytes.lower()``
    then follow the word and A-Z rules exactly (ASCII only)."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def column_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a string column without nulls, one after another, and
    where each text's words begin and end."""
    lists = pc.ascii_split_whitespace(texts)
    flat, edges = lists.flatten(), lists.offsets.to_numpy()
    full = pc.not_equal(pc.binary_length(flat), 0)
    edges = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))[edges - edges[0]]
    return flat.filter(full), edges


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "creditlens_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema) -> DataFrame:
    """``fn`` over every Arrow batch of every partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if out is not None and out.num_rows:
                yield out
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


_KEPT: dict[Hashable, object] = {}


def keep(key: Hashable, build: Callable[[], object]):
    """What the tasks of an operator keep in a worker from one to the next.
    Workers go on to other operators, so what another has kept goes first."""
    if key not in _KEPT:
        release()
        _KEPT[key] = build()
    return _KEPT[key]


def release() -> None:
    """Let go of what earlier tasks have kept in this worker."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder_is(key: Column, modulus: int, value: int) -> Column:
    """crc32(key as text) mod ``modulus`` = ``value``; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == value, F.lit(False))

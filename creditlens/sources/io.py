"""Sources and sinks (SRC-01..11).

CSV is read with a declared schema, or with one that ``infer_schema`` finds in
a single aggregate; ``read_csv_checked`` also gives the cells that do not fit.
The first-available loader tries an ordered list of candidate paths and
reports which one it used; sinks write partitioned files (no ``coalesce(1)``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: Decimals with more places than this are read as DOUBLE.
MAX_SCALE = 4


def read_csv(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """SRC-01 header CSV, SRC-02 explicit schema instead of an inference
    pass, SRC-03 date columns typed by the schema.  Columns are matched by
    header name (order and extra columns do not matter, missing ones are
    NULL) and converted with ``try_cast`` (a malformed value becomes NULL,
    like a lenient parse)."""
    struct = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    if not header:
        return spark.read.schema(struct).option("mode", "PERMISSIVE").csv(path)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    present = set(raw.columns)
    cols = [F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})").alias(f.name) if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields]
    return raw.select(*cols)


# ------------------------------------------------ types found in the text
#
# The types form a lattice: a column is of the narrowest type that all of its
# values have, and what is gathered per column (does every value fit the type,
# how many digits and places) merges in any order.

def _facts(c: str) -> list[Column]:
    v = F.trim(F.col(f"`{c}`"))
    v = F.when(v != "", v)
    number = v.rlike(r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?$")  # a leading zero is part of a code, not of a number
    whole, places = F.length(F.regexp_extract(v, "([0-9]+)", 1)), F.length(F.regexp_extract(v, r"\.([0-9]+)$", 1))
    has = lambda kind: F.expr(f"try_cast(trim(`{c}`) as {kind})").isNotNull()
    every = lambda test: F.bool_and(F.when(v.isNotNull(), test))
    fits = {
        "n": F.count(v),
        "bigint": every(number & (places == 0) & has("bigint")),
        "decimal": every(number & (places <= MAX_SCALE)),
        "double": every(v.rlike(r"^[+-]?([0-9]|\.[0-9])") & ~v.rlike("^[+-]?0[0-9]") & has("double")),
        "boolean": every(F.lower(v).isin("true", "false")),
        "date": every(v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & has("date")),
        "timestamp": every(v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T]") & has("timestamp")),
        "whole": F.max(F.when(number, whole)), "places": F.max(F.when(number, places)),
    }
    return [f.alias(f"{c}|{name}") for name, f in fits.items()]


def _type_of(facts: dict) -> str:
    if not facts["n"]:
        return "string"
    if facts["decimal"] and not facts["bigint"] and facts["whole"] + facts["places"] <= 38:
        return f"decimal({18 if facts['whole'] + facts['places'] <= 18 else 38},{facts['places']})"
    return next((t for t in ("bigint", "double", "boolean", "date", "timestamp") if facts[t]), "string")


def column_types(raw: DataFrame) -> list[tuple[str, str, int]]:
    """``(column, type, values)`` of text columns, from one aggregate over all
    rows.  Blank cells have no say; a column without values, or without a type
    that all its values have, is a string.  Numbers with leading zeros are
    codes; whole numbers are bigint, plain decimals of at most MAX_SCALE places
    decimal, other numbers double."""
    if not raw.columns:
        return []
    row = raw.agg(*[f for c in raw.columns for f in _facts(c)]).first().asDict()
    found = {c: {k.rsplit("|", 1)[1]: v for k, v in row.items() if k.rsplit("|", 1)[0] == c} for c in raw.columns}
    return [(c, _type_of(f), f["n"]) for c, f in found.items()]


def infer_schema(spark: SparkSession, path: str) -> StructType:
    """SRC-02: the types of a header CSV, found in its values."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return StructType([StructField(c, _parse_datatype_string(t)) for c, t, _ in column_types(raw)])


def read_csv_checked(spark: SparkSession, path: str, schema=None) -> tuple[DataFrame, DataFrame]:
    """A header CSV as :func:`read_csv` types it (``schema`` None: inferred), and
    its rejected cells ``(file, column, type, value)``: values that are not
    blank and do not have the column's type (NULL in the first table)."""
    struct = infer_schema(spark, path) if schema is None else (
        schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    checked = [f for f in struct.fields if f.name in raw.columns and f.dataType.simpleString() != "string"]
    cells = F.array(*[F.when((F.trim(F.col(f"`{f.name}`")) != "") & F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})").isNull(),
                             F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                                      F.col(f"`{f.name}`").alias("value"))) for f in checked])
    none = F.array().cast("array<struct<column:string,type:string,value:string>>")
    bad = (raw.select(F.input_file_name().alias("file"), F.explode(
        F.filter(cells, lambda x: x.isNotNull()) if checked else none).alias("x")).select("file", "x.*"))
    return read_csv(spark, path, struct), bad


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    if path.endswith(".csv") or "/csv" in path:
        return read_csv(spark, path, schema)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def first_available(spark: SparkSession, paths: Sequence[str], schema=None) -> tuple[DataFrame, str]:
    """SRC-05: the first readable candidate (cleaned, alternate, raw ...) and
    the path used, so callers can switch behaviour (e.g. currency fallback)."""
    for p in paths:
        if _exists(spark, p):
            return read_table(spark, p, schema), p
    raise FileNotFoundError(f"none of {list(paths)} exists")


def schema_only(spark: SparkSession, path: str) -> StructType:
    """SRC-04: the schema from file metadata, without a job."""
    return spark.read.parquet(path).schema


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """SRC-08 / SRC-09 / SRC-11: overwrite a table folder; nested columns are
    kept as-is in parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)

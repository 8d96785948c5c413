"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (columns sorted by name).  Floats are compared with a
relative tolerance; ``exact=True`` reports last-bit differences too.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.{digits}g}") if digits else v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()[:10] if isinstance(v, _dt.date) and not isinstance(v, _dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare_rows(spark_rows, spark_cols, duck_rows, duck_cols, digits=12):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: spark-only {sorted(set(spark_cols)-set(duck_cols))}, " \
                      f"oracle-only {sorted(set(duck_cols)-set(spark_cols))}"
    if len(spark_rows) != len(duck_rows):
        return False, f"row count {len(spark_rows)} vs {len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i], digits) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i], digits) for i in di) for r in duck_rows), key=_key)
    for ra, rb in zip(a, b):
        if ra != rb:
            diffs = [(order[j], ra[j], rb[j]) for j in range(len(order)) if ra[j] != rb[j]]
            return False, f"first differing row: {diffs[:6]}"
    return True, "ok"


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "DateType": "DATE", "FloatType": "FLOAT", "ShortType": "SMALLINT",
                 "ByteType": "TINYINT"}


def type_diffs(df, con, sql):
    st = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}
    rel = con.sql(sql)
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, st[c], dt.get(c)) for c in st if st[c] != dt.get(c)]


def check(spark, query_fn, sql: str, sf_dir: str, digits=12, types=False):
    df = query_fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    con = duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok, msg = compare_rows(srows, scols, drows, dcols, digits)
    if ok and types:
        diffs = type_diffs(df, con, sql)
        if diffs:
            ok, msg = False, f"column types differ: {diffs[:6]}"
    return ok, msg, len(srows)

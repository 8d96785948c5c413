"""Bucketed, versioned and nested tables, as-of joins, types and rejects of CSV text."""
import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from creditlens.operators import entities, reports
from creditlens.operators.asof import asof_join
from creditlens.operators.rollup import account_table
from creditlens.sources import buckets, io, roles, versions
from creditlens.sources.extracts import Sources, schemas
from creditlens.sources.tables import Tables


def test_bucketed_sources_give_the_same_account_table(spark, tmp_path):
    t = Tables(spark, SF_SMALL)
    src = buckets.bucket_sources(Sources.from_tables(t), 4, str(tmp_path))
    a, b = (account_table(x).select(sorted(account_table(x).columns)) for x in (t, src))
    assert a.dtypes == b.dtypes and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
    files = [f for f in (tmp_path).rglob("*.parquet") if "transactions" in str(f)]
    assert len(files) == 4  # one file per bucket
    buckets.drop_bucketed(src)
    assert not [x for x in spark.catalog.listTables() if x.name.endswith(src.origin.rsplit("-", 1)[-1])]


# ---------------------------------------------------------------- versions

def test_a_failing_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)
    versions.write_version(spark.range(3), root, {"by": "one"})
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception):
        versions.write_version(bad, root)
    assert versions.read_version(spark, root).count() == 3
    assert versions.current(spark, root)["facts"] == {"by": "one"} and versions.current(spark, root)["number"] == 1
    old = versions.read_version(spark, root)
    versions.write_version(old.union(old), root)  # a table can be replaced from itself
    assert versions.read_version(spark, root).count() == 6 and old.count() == 3


def test_two_writers_of_one_number(spark, tmp_path):
    root = str(tmp_path / "t")

    def slow(folder):  # another writer finishes in between
        versions.write_version(spark.range(2), root)
        spark.range(5).write.parquet(folder)

    with pytest.raises(Exception):
        versions.publish(spark, root, slow)
    assert versions.read_version(spark, root).count() == 2


def test_profile_is_observed_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a"), (2, 2.0, None), (None, None, "c")], "a int, `b x` double, c string")
    counts = reports.write_profiled(df, str(tmp_path))
    assert counts == {"rows": 3, "nulls": {"a": 1, "b x": 2, "c": 1}}
    want = {r.column_name: r.null_count for r in reports.null_counts(versions.read_version(spark, str(tmp_path))).collect()}
    assert counts["nulls"] == want and versions.current(spark, str(tmp_path))["facts"] == counts
    assert reports.write_profiled(df.limit(0), str(tmp_path))["rows"] == 0


# ------------------------------------------------------------ nested chunks

@pytest.mark.parametrize("size, partitions", [(1, 3), (3, 7), (1000, 2)])
def test_chunks_hold_every_row_in_order(spark, size, partitions):
    rng = random.Random(size)
    rows = [(rng.choice((1, 1, 1, 2, 3, None)), rng.choice((None, "a", "b")), rng.randint(0, 3)) for _ in range(120)]
    df = spark.createDataFrame(rows, "k long, s string, n int").repartition(4)
    chunks = entities.chunked(df, "k", size, partitions).cache()
    assert max(r.n for r in chunks.select(F.size("rows").alias("n")).collect()) <= size
    got = [(r.k, r.place, r.s, r.n) for r in entities.flatten_chunks(chunks, "k", size).collect()]
    order = lambda r: (r[1] is not None, r[1] or "", r[2])
    want = [(k, i, s, n) for k in {r[0] for r in rows}
            for i, (_, s, n) in enumerate(sorted((r for r in rows if r[0] == k), key=order))]
    assert Counter(got) == Counter(want)
    assert entities.chunked(df.limit(0), "k").count() == 0


def test_nested_rows_flatten_to_the_fact_tables(spark):
    t = Tables(spark, SF_SMALL)
    nested = entities.nested_account_rows(t, 3)
    flat = entities.flatten_chunks(nested["transaction"], "current_account_nbr", 3).drop("place")
    facts = roles.transactions(t).select(flat.columns)
    assert flat.exceptAll(facts).count() == 0 == facts.exceptAll(flat).count()


# ---------------------------------------------------------------- as-of join

@pytest.mark.parametrize("partitions", [1, 2, 9, 40])
def test_asof_against_a_plain_search(spark, partitions):
    rng = random.Random(partitions)
    start = dt.datetime(2024, 1, 1)
    at = lambda: rng.choice((None, *[start + dt.timedelta(seconds=rng.randint(0, 60), microseconds=rng.randint(0, 2)) for _ in range(9)]))
    key = lambda: rng.choice(("a", "a", "a", "a", "b", "c", None))
    left = [(i % 40, key(), at()) for i in range(90)]  # with repeated rows
    right = [(key(), at(), rng.choice((None, 1.0, 2.0, 3.0)), rng.randint(0, 5)) for _ in range(60)] + [("d", start, 1.0, 1)]
    out = asof_join(spark.createDataFrame(left, "id int, k string, t timestamp_ntz").repartition(3),
                    spark.createDataFrame(right, "k string, t timestamp_ntz, rate double, n int").repartition(2),
                    "k", "k", "t", "t", ["rate", "n"], partitions)
    assert out.columns == ["id", "k", "t", "rate", "n"]

    def latest(k, t):
        found = [(u, (v is not None, v or 0), n, v) for kk, u, v, n in right if kk == k and u is not None and t is not None and u <= t]
        return (lambda x: (x[3], x[2]))(max(found)) if k is not None and found else (None, None)

    assert Counter(map(tuple, out.collect())) == Counter((i, k, t, *latest(k, t)) for i, k, t in left)


def test_asof_of_nothing(spark):
    left = spark.createDataFrame([(1, "a", 5)], "id int, k string, t int")
    none = spark.createDataFrame([], "k string, t int, v int")
    assert [tuple(r) for r in asof_join(left, none, "k", "k", "t", "t", ["v"]).collect()] == [(1, "a", 5, None)]
    assert asof_join(left.limit(0), none, "k", "k", "t", "t", ["v"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(left.withColumn("v", F.lit(1)), none, "k", "k", "t", "t", ["v"])


# ------------------------------------------------------------------ CSV text

def test_types_of_text(spark):
    cols = {"i": ["1", "-20", "", None], "code": ["007", "12", "3", None], "d2": ["1.50", "2.25", "3", None],
            "d38": ["123456789012345678901.25", "1", None, "0.5"], "x": ["1.5", "2e10", "0.123456", None], "b": ["true", "FALSE", None, None],
            "day": ["2024-02-29", None, " ", "1999-12-31"], "bad_day": ["2024-02-30", "2024-01-01", None, None],
            "ts": ["2024-01-01 10:00:00", "2024-01-01T10:00:00.5", None, None], "mixed": ["1", "a", None, None],
            "void": [None, "", None, " "], "big": ["9223372036854775808", "1", None, None], "day_or_ts": ["2024-01-01", "2024-01-01 01:00:00", None, None]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} string" for c in cols))
    got = {c: (t, n) for c, t, n in io.column_types(df.repartition(3))}
    assert got == {"i": ("bigint", 2), "code": ("string", 3), "d2": ("decimal(18,2)", 3), "d38": ("decimal(38,2)", 3), "x": ("double", 3),
                   "b": ("boolean", 2), "day": ("date", 2), "bad_day": ("string", 2), "ts": ("timestamp", 2), "mixed": ("string", 2),
                   "void": ("string", 0), "big": ("decimal(38,0)", 2), "day_or_ts": ("string", 2)}


def test_extracts_infer_to_their_declared_types(spark, tmp_path):
    Sources.from_tables(Tables(spark, SF_SMALL)).write_extracts(str(tmp_path))
    family = lambda t: "bigint" if t in ("int", "bigint") else t.split("(")[0]
    for name, declared in schemas("bigint").items():
        if name == "us_equiv_amt":
            continue
        want = {f.name: family(f.dataType.simpleString()) for f in spark.createDataFrame([], declared).schema}
        path = f"{tmp_path}/{name}.csv"
        raw = spark.read.option("header", True).csv(path)
        filled = {c for c, _, n in io.column_types(raw) if n}
        got = {f.name: family(f.dataType.simpleString()) for f in io.infer_schema(spark, path)}
        differ = {c: (got[c], want[c]) for c in filled if got[c] != want[c]}
        # text dates of the identity map are declared as text
        assert differ in ({}, {"closed_date": ("date", "string")}), (name, differ)
        rows, bad = io.read_csv_checked(spark, path, declared)
        assert bad.count() == 0 and rows.count() == raw.count()


def test_rejected_cells(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    io.write_table(spark.createDataFrame([("1", "2.5", "x"), ("b", "", None), (None, "9", "y"), ("3.5", "1e400x", "z")],
                                         "a string, b string, c string"), path, "csv")
    rows, bad = io.read_csv_checked(spark, path, "a bigint, b double, c string, missing date")
    assert rows.columns == ["a", "b", "c", "missing"] and rows.count() == 4
    assert sorted(tuple(r) for r in bad.select("column", "type", "value").collect()) == [
        ("a", "bigint", "3.5"), ("a", "bigint", "b"), ("b", "double", "1e400x")]
    assert bad.where("file like '%x.csv%'").count() == 3
    assert io.read_csv_checked(spark, path)[1].count() == 0  # inferred types fit every value

"""Micro-fixtures with hand-derived answers (FIXTURES.md §3) and rule edge cases."""
import math

import pytest
from pyspark.sql import functions as F

from creditlens.functions import rules as R


def _rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


PH_CASES = [
    (None, (0, 0, 0, 0, 0)),
    ("", (0, 0, 0, 0, 0)),
    ("AAAA", (0, 0, 0, 0, 4)),
    (" b2Zq% ", (2, 2, 1, 1, 1)),
    ("0A", (0, 0, 0, 0, 1)),
    ("UVWX", (0, 0, 0, 0, 0)),
    ("HP7", (3, 7, 0, 0, 0)),
    ("89", (0, 0, 0, 0, 0)),
    ("%#+-", (0, 0, 0, 4, 0)),
]


def test_payment_history(spark):
    df = _rows(spark, [(i, s) for i, (s, _) in enumerate(PH_CASES)], "i int, h string")
    out = {r["i"]: tuple(r[m] for m in R.PAYMENT_METRICS)
           for r in df.select("i", *R.payment_history_columns("h", "")).collect()}
    for i, (_, want) in enumerate(PH_CASES):
        assert out[i] == want, PH_CASES[i]


SEG_CASES = [  # util, score, risk, A, B
    (50.0, 700.0, 0, 0, 0), (30.0, 700.0, 0, 2, 2), (20.0, 600.0, 0, 1, 2), (70.0, 670.0, 0, 0, 0),
    (70.01, 800.0, 0, 1, 1), (50.0, 669.0, 0, 1, 1), (50.0, 700.0, 1, 3, 3),
]


def test_segments(spark):
    df = _rows(spark, [c[:3] for c in SEG_CASES], "u double, s double, r int")
    got = df.select(R.segment_a("u", "s", "r").alias("a"), R.segment_b("u", "s", "r").alias("b")).collect()
    assert [(g["a"], g["b"]) for g in got] == [(c[3], c[4]) for c in SEG_CASES]


def test_max_cli_pct(spark):
    cases = [(0, 750.0, 0, .25), (0, 700.0, 1, .25), (0, 699.0, 0, .15), (1, 700.0, 0, .15), (1, 650.0, 1, .15),
             (1, 649.0, 0, .05), (2, 800.0, 1, 0.0), (3, 800.0, 0, 0.0)]
    df = _rows(spark, [c[:3] for c in cases], "seg int, s double, hi int")
    got = [r[0] for r in df.select(R.max_cli_pct("seg", "s", "hi")).collect()]
    assert all(math.isclose(g, c[3], abs_tol=1e-12) for g, c in zip(got, cases))


def test_cli_postprocess(spark):
    cases = [(100.0, 1.0, .25, True, 0, 500.0), (9000.0, 20.0, .25, True, 0, 5000.0),
             (9000.0, 20.0, .30, True, 1, 6000.0), (-50.0, 20.0, .25, True, 0, -50.0),
             (9000.0, 20.0, .25, False, 0, 0.0)]
    df = _rows(spark, [c[:5] for c in cases], "p double, line double, pct double, e boolean, hi int")
    got = [r[0] for r in df.select(R.cli_postprocess("p", "line", "pct", "e", "hi")).collect()]
    assert got == [c[5] for c in cases]


def test_literal_rules(spark):
    df = _rows(spark, [("SALE", 10.0, 8.0), ("RETURN", 10.0, None), ("OTHER", 10.0, 0.0)],
               "t string, a double, us double")
    assert [r[0] for r in df.select(R.signed_amount("t", "a", "us")).collect()] == [8.0, -10.0, 10.0]

    codes = _rows(spark, [(None,), ("Y",), ("H",), ("N",)], "c string")
    assert [r[0] for r in codes.select(R.income_from_code("c")).collect()] == [0, 0, 1, None]

    flags = _rows(spark, [("Yes",), ("T",), ("1",), ("n",), (None,)], "f string")
    assert [r[0] for r in flags.select(R.text_flag("f")).collect()] == [1, 1, 1, 0, 0]

    labels = _rows(spark, [("High_Risk",), ("other",), (None,)], "l string")
    assert [r[0] for r in labels.select(R.segment_from_text("l")).collect()] == [3, 2, 2]
    nums = _rows(spark, [(7.0,), (-1.0,), (None,)], "l double")
    assert [r[0] for r in nums.select(R.segment_from_number("l")).collect()] == [3, 0, 2]


def test_growth_rules(spark):
    df = _rows(spark, [(0.0, 5.0), (0.5, 10.0), (1.0, 9.0)], "a double, b double")
    got = df.select(R.growth_clipped("a", "b").alias("g3"), R.ratio_growth("a", "b").alias("g5")).collect()
    assert got[0]["g3"] == 0.0 and got[1]["g3"] == 5.0
    assert got[0]["g5"] == 1.0 and got[2]["g5"] == 5.0


def test_clip_keeps_null_and_inf_to_null(spark):
    df = _rows(spark, [(None,), (float("inf"),), (5.0,), (float("nan"),)], "x double")
    got = df.select(R.clip("x", 0.0, 3.0).alias("c"), R.inf_to_null("x").alias("n")).collect()
    assert got[0]["c"] is None and got[1]["c"] == 3.0 and got[2]["c"] == 3.0
    assert got[1]["n"] is None and got[2]["n"] == 5.0 and got[3]["n"] is None


def test_value_tiers_edges(spark):
    from creditlens.operators.reports import value_tiers
    df = _rows(spark, [(i, float(i), 1.0) for i in range(1, 7)], "user_id int, v double, m double")
    out = {r["value_tier"]: r["n_users"] for r in value_tiers(df, "v", "m").collect()}
    assert out == {"Low": 2, "Medium": 2, "High": 2}


def test_activation_delay_floors(spark):
    df = _rows(spark, [("2024-01-02 00:00:00", "2024-01-01 23:00:00")], "o string, a string")
    secs = F.unix_timestamp(F.to_timestamp("a")) - F.unix_timestamp(F.to_timestamp("o"))
    assert df.select(F.floor(secs / 86400)).first()[0] == -1

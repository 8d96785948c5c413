"""How the master build moves rows: narrow ones, and sums only where a task holds its share of the keys."""
import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from creditlens.operators import rollup
from creditlens.sources import roles


def tables(spark, lines, events=()):
    day = dt.datetime(1997, 1, 1)
    li = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_shipdate timestamp_ntz, l_linenumber int, l_extendedprice double")
    li = li.withColumns({"l_returnflag": F.lit("A"), "l_linestatus": F.lit("F"), "l_discount": F.lit(0.0), "l_tax": F.lit(0.0)})
    ev = spark.createDataFrame(list(events), "event_id long, user_id long, event_type string, value double, ts timestamp_ntz")
    orders = spark.createDataFrame([(1, 7, "O", "5-LOW", day, 10.0), (2, None, "O", "5-LOW", day, 10.0), (None, 7, "O", "5-LOW", day, 10.0)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz, o_totalprice double")
    customer = spark.createDataFrame([(7, 1.0), (7, 2.0), (None, 3.0)], "c_custkey long, c_acctbal double")
    return SimpleNamespace(lineitem=li, events=ev, orders=orders, customer=customer)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].split("\n")


def test_rows_are_dealt_by_key_before_they_are_added(spark):
    t = tables(spark, [(1, 1, dt.datetime(1997, 1, 1), 3, 1.0)])
    lines = roles.line_facts(t, roles.PERIODS.span(), rollup.with_signed_amount, rollup.pivot_measures(roles.PERIODS))
    accounts = spark.createDataFrame([(7, 1)], "user_id long, is_active_account int")
    for df in (lines, roles.event_facts(t), rollup.user_rollup(accounts)):
        plan = plan_of(df)
        sums = [i for i, line in enumerate(plan) if "HashAggregate" in line]
        assert sums and max(sums) < min(i for i, line in enumerate(plan) if "Exchange" in line)


def test_histories_keep_the_smallest_code_of_each_month(spark):
    at = lambda y, m: dt.datetime(y, m, 3)
    code = lambda c: roles.HIST_CODES.index(c)
    t = tables(spark, [(1, code("Z"), at(1998, 12), 1, 1.0), (1, code("B"), at(1998, 12), 2, 1.0), (1, code("#"), at(1998, 7), 3, 1.0),
                       (1, code("Q"), at(1997, 12), 4, 1.0), (1, code("J"), at(1996, 12), 5, 1.0), (1, code("3"), at(1998, 1), 6, 1.0),
                       (1, code("%"), None, 7, 1.0), (None, code("A"), at(1998, 8), 1, 1.0), (3, None, at(1998, 8), 1, 1.0)])
    lines = roles.line_facts(t, roles.PERIODS.span(), rollup.with_signed_amount, rollup.pivot_measures(roles.PERIODS))
    got = {r[0]: (r[1], r[2]) for r in lines.select("current_account_nbr", "payment_hist_1_12_mths", "payment_hist_13_24_mths").collect()}
    assert got == {1: ("#B", "%3J"), 3: (None, None)}
    users = {(r.user_id, r.payment_hist_13_24_max_delinquency, r.credit_line)
             for r in rollup.user_rollup(rollup.account_table(t)).collect()}
    assert [u[:2] + (float(u[2]),) for u in users] == [(7, 3, 20.0)]  # two rows of the customer: the account counts twice

"""The driver contract in __spark_entry__.py."""
import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark):
    m = _entry_module()
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["segment_label", "n_users", "avg_credit_line", "avg_utilization_pct", "total_spend_2024"]


def test_oracle_keys_are_queries():
    m = _entry_module()
    q, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(q)
    assert all(isinstance(s, str) and s.strip() for s in sql.values())
    assert len(q) >= 100

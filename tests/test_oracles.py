"""Every registered query against its DuckDB oracle (exact values)."""
import pytest

import oracle_util as U
from conftest import SF_SMALL
from creditlens.plans import registry

registry.load_all()
WITH_SQL = sorted(registry.ORACLE)
NO_SQL = sorted(set(registry.QUERIES) - set(registry.ORACLE))


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, name):
    ok, msg, _ = U.check(spark, registry.QUERIES[name], registry.ORACLE[name](), SF_SMALL, digits=17, types=True)
    assert ok, msg


def test_every_query_has_an_oracle_or_is_a_model():
    assert all(n in ("q4_forecast", "q3_backtest", "segment_model", "risk_model", "cli_model", "full_flow",
                     "model_metrics")
               or n in registry.ORACLE for n in registry.QUERIES)

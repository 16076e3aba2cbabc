"""Every SQL-checked query against its DuckDB oracle on the smallest tables."""
import pytest

from oracle_compare import compare, duck
from panelcast.plans.oracle import build
from panelcast.plans.queries import registry

SF = "/root/testdata/sf0.001"
SQLS = build()
QUERIES = registry()
# Queries that SQL can't express: MLlib's forests, and what contains them.
NO_SQL = {"forest_forecast", "two_stage_forecast", "full_backtest_best"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(SQLS))
def test_query_matches_oracle(spark, con, name):
    out = compare(spark, SF, name, QUERIES[name], SQLS[name], con)
    assert out["match"], out


def test_registry_and_entry_contract():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q)
    assert set(QUERIES) - set(o) == NO_SQL

"""Every query with a SQL oracle gives the oracle's rows."""

import pytest
from compare import compare, connect
from conftest import SF

import __spark_entry__ as entry_module

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry_module.entry(spark)
    assert rows.columns == ["id", "risk_score", "top_signals", "explanation"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    verdict, _ = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert verdict == "ok"

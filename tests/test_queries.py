"""Every named query: against its SQL twin, or for rows where it has none."""

import pytest
import sqlcheck

import __spark_entry__ as entry_module
from evenkeel.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return sqlcheck.connect(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_query_equals_sql(spark, sf_dir, con, name):
    item = REGISTRY[name]
    df = item.run(spark, sf_dir)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert sqlcheck.differences(df, con, item.sql) is None


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert REGISTRY[name].run(spark, sf_dir).count() > 0


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0

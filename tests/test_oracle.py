"""Every registered query against its SQL, all rows and types."""

import pytest
from conftest import SF_DIR
from oracle_compare import connect, differences

import __spark_entry__ as entry_module

from signalfold.plans.oracle import ORACLE  # noqa: E402
from signalfold.plans.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLE[name], con) == []


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["date", "daily_active_users", "total_events", "total_sessions"]
    assert df.count() > 0

"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
import oracle_check
from copse.plans import catalog, oracle


@pytest.fixture(scope="module")
def con(folder):
    return oracle_check.connect(folder)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, folder, name):
    result = oracle_check.compare(spark, con, folder, catalog.QUERIES[name], oracle.SQL.get(name))
    assert not result.startswith("FAIL"), result


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Every registered query equals its DuckDB oracle on the driver tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare, duck
from tests.conftest import SF_SMALL

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn = queries()[name]
    sql = oracle_sql().get(name)
    if sql is None:
        assert fn(spark, SF_SMALL).count() >= 0
        return
    ok, n, _, detail = compare(spark, con, name, fn, sql, SF_SMALL)
    assert ok, detail


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 25 and "bottleneck" in df.columns

"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

from harness.check import compare, duck_connection

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

QUERIES = entry_mod.queries()
ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    from harness.queries import QUERIES as LIBRARY
    assert set(LIBRARY) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["columns_match"] and r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "sensor_reading_sk"

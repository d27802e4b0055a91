"""Every registered query against DuckDB on the smallest sample tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference

QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, tiny, duck):
    assert difference(QUERIES[name](spark, tiny), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(name, spark, tiny):
    assert QUERIES[name](spark, tiny).count() > 0


def test_entry(spark):
    rows = {r["alert_level"]: r["count"] for r in contract.entry(spark).collect()}
    assert set(rows) == {"LOW", "MEDIUM", "HIGH", "CRITICAL"}

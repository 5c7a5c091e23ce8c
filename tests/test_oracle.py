"""Every query against DuckDB on the same tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences
from checks.oracle import all_oracles
from checks.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, folder, sql, name):
    assert differences(QUERIES[name](spark, folder), sql, ORACLES[name]) == ""


def test_entry_gives_one_row(spark):
    assert entry(spark).count() == 1

"""Every registered query against its SQL."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    return compare.connect(sf)


#: The training-data queries have tests of their own beside their package.
OWN = [name for name in QUERIES if not name.startswith("op") and name != "pipeline"]


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, sf, db, name):
    assert not compare.differences(QUERIES[name](spark, sf), db, SQL[name])[:3]


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert {r.dataset_id for r in entry(spark).collect()} == {"customers.csv", "orders.csv", "suppliers.csv"}

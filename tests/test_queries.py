"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["year", "median_price_per_sqm"]
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert df.columns

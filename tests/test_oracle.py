"""Every registered query against its SQL, whole tables, smallest scale."""

import pytest

from compare import compare, connect
from driver_queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], ORACLES.get(name)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["source", "words", "n", "rank"] and df.count() > 0
    assert entry.queries().keys() >= entry.oracle_sql().keys()

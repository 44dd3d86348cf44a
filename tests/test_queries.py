"""Every registered query at the small scale, against DuckDB where there is SQL."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    text, rows = difference(spark, con, QUERIES[name], ORACLES.get(name), SF)
    assert text == ""
    assert rows > 0 or name in ("homology_pairs",)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

"""Every registered query against its SQL, at the smallest scale."""

import pytest
from check_oracles import connect, same

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


OWN = [n for n in queries() if not n.startswith("op") and n != "pipeline"]


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert same(queries()[name](spark, SF).toPandas(), con.execute(SQL[name]).df()) == ""


def test_entry(spark):
    out = entry(spark)
    assert out.columns == ["paper_id", "P0", "P1", "P2", "total_flags"] and out.count() > 0

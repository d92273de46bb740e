import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = connect(SF)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    assert difference(contract.queries()[name](spark, SF), database, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 156

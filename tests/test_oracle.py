import os

import pytest

import __spark_entry__ as contract
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.compare import connect, duck_rows, spark_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    columns, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    wanted_columns, wanted = duck_rows(con, contract.oracle_sql()[name])
    assert columns == wanted_columns
    assert len(rows) == len(wanted) > 0
    assert rows == wanted


def test_entry(spark):
    assert contract.entry(spark).count() > 0

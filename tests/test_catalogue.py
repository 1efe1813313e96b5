import pytest

import __spark_entry__
from spanforge.plans import catalogue
from tests.compare import connection, differences

SF = "/root/testdata/sf0.001"
SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert differences(spark, con, catalogue.queries()[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_has_rows(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 2
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

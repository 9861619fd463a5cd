import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallystream.plans.queries import QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, db, name):
    assert compare(spark, db, name, SF) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "Year" and df.where("Year = 'AVERAGE'").count() == 1

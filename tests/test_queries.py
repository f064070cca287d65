"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as registry
from check_queries import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


#: Queries of operators for training data are tested with their subpackage.
OWN = sorted(set(registry.queries()) - set(registry._training_data()[0]))


def test_every_query_has_sql():
    assert set(OWN) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, database, name):
    found = registry.queries()[name](spark, SF).toArrow()
    expected = database.sql(registry.oracle_sql()[name]).to_arrow_table()
    assert found.num_rows > 0
    assert difference(found, expected) is None


def test_entry(spark):
    assert registry.entry(spark).columns == ["ord", "metric", "value"]

import pytest

from edgeloom.plans import geometry, queries, round_trips
from tests.compare import connection, same

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.QUERIES | round_trips.QUERIES | geometry.QUERIES, queries.ORACLES | round_trips.ORACLES | geometry.ORACLES


@pytest.fixture(scope="module")
def con():
    return connection(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    same(QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df())

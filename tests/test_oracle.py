"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from tests import compare as side_by_side

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
QUERIES = {q.__name__: q for q in side_by_side.contract._QUERIES}
ORACLE = side_by_side.contract.own_oracle_sql()


@pytest.fixture(scope="module")
def db():
    return side_by_side.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    assert side_by_side.compare(spark, db, name, SF) == []


def test_every_query_has_sql(spark):
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    rows = side_by_side.contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"heart_rate_zone", "o2_risk", "n", "mean_risk"}

"""Every query with SQL is compared row by row on the smallest folder."""

import pytest

from claimloom.plans.catalog import QUERIES
from claimloom.plans.oracle import ORACLE
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_names():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    rows, diff = differences(spark, con, FOLDER, name)
    assert rows > 0 and not diff, diff[:3]

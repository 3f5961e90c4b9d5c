"""Every registered query against its SQL on the smallest tables."""

import pytest

from check import TABLES, compare, connect
from leaguelake.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert len(TABLES) == 14


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(con, QUERIES[name](spark, SF_DIR), SQL[name]) == ""

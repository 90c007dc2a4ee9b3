"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle import connect, differences

from brightmere.plans import QUERIES, SQL

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert differences(spark, con, name, QUERIES[name], SQL[name], FOLDER) == []
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)

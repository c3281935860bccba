"""Every registered query against its SQL."""

import pytest
from oracle import connect, mismatch

from tallybook.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), db, ORACLE[name]) is None

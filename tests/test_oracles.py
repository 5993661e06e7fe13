"""Every registered query against its SQL oracle."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, differences

ORACLES = oracle_sql()
#: Queries of the optional training-data package have their own tests.
QUERIES = {k: q for k, q in queries().items() if not re.match(r"op\d+_|pipeline$", k)}


@pytest.fixture(scope="module")
def con(root):
    return connect(root)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_matches_oracle(spark, root, con, key):
    assert differences(QUERIES[key](spark, root), con, ORACLES[key]) == []


def test_entry(spark):
    assert entry(spark).count() > 0

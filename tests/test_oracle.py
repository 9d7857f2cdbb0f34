"""Every query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

from checks.compare import compare, connect
from checks.oracle import SQL
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, key):
    assert compare(spark, con, key, sf_dir) == ""

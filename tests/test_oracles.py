"""Every registered query against its SQL."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_DIR
from tidemark.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert queries().keys() >= QUERIES.keys()
    assert oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    compare(spark, db, name, SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0

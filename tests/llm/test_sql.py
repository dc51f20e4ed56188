"""Registered queries that SQL can express, over whole tables."""

import duckdb
import pytest
from helpers import SF_DIR, key

from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(names)
    want = sorted(result.fetchall(), key=key)
    assert sorted(map(tuple, got.select(*names).collect()), key=key) == want


def test_all_operators_have_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))

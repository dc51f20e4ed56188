"""Runs registered queries against DuckDB: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return db


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda row: repr(row)
    )


def compare(spark, db, name: str, sf: str) -> int:
    """Rows of the query; raises where columns or rows differ from the SQL's."""
    df = queries()[name](spark, sf)
    ours = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan, f"{name}: {plan}"
    result = db.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns), (name, df.columns, columns)
    expected = _rows(columns, result.fetchall())
    got = _rows(df.columns, ours)
    assert len(got) == len(expected), f"{name}: {len(got)} rows, SQL has {len(expected)}"
    for one, other in zip(got, expected):
        assert one == other, f"{name}: {one} is not {other}"
    return len(got)


if __name__ == "__main__":
    from tidemark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    for name in sys.argv[2:] or oracle_sql():
        start = time.time()
        try:
            print(f"{name}: {compare(session, connection, name, sf)} rows, "
                  f"{time.time() - start:.1f} s", flush=True)
        except Exception as error:
            print(f"{name}: FAILED {str(error)[:600]}", flush=True)

"""The operators run on the supplied tables, each next to the SQL that must give the same.

A query reads whole tables: those of the supplied folder, or files and tables that it has
Spark derive from them below the session's scratch folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import standins
from tidemark.functions import (
    collapse_whitespace,
    legacy_timestamp,
    legacy_timestamp_invalid,
)
from tidemark.operators import (
    EmptyTableError,
    best_of,
    duplicate_keys,
    enrich,
    in_open_window,
    latest,
    require_rows,
    row_counts,
    top_k,
    top_k_counted,
    top_k_enriched,
    upsert,
)
from tidemark.plans import (
    AUTHOR_LISTS,
    BOOK_LISTS,
    DailyTotals,
    KeyLists,
    RepeatedKeys,
    read_accepted,
    refresh,
    refresh_lists,
)
from tidemark.plans.incremental import refresh_new
from tidemark.schemas import (
    BEST_BOOKS_INTEGER,
    DOUBLE,
    INT,
    LONG,
    REVIEWS,
    TEXT,
    TIME,
    TableSpec,
    struct,
)
from tidemark.session import scratch_path
from tidemark.sinks import BucketedTable, Database, merged_over_salts, write_processed
from tidemark.sinks.folders import Folders
from tidemark.sources import read_delimited, read_processed
from tidemark.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LOW, HIGH = "1995-01-01 00:00:00", "1996-01-01 00:00:00"
IN_WINDOW = f"l_shipdate > TIMESTAMP '{LOW}' AND l_shipdate < TIMESTAMP '{HIGH}'"
# Python's whitespace characters as the other engine's regular expressions write them.
WHITESPACE_SQL = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def register(sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _database(spark: SparkSession, label: str, **layout) -> Database:
    return Database(spark, f"{label}_{uuid.uuid4().hex}", scratch_path(spark, label), **layout)


# ---------------------------------------------------------------- latest record per key


@register("""
    SELECT o.* FROM orders o JOIN (
        SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey
    ) m ON o.o_custkey = m.o_custkey AND o.o_orderdate = m.o_orderdate
""")
def dedup_latest_orders(spark: SparkSession, sf: str) -> DataFrame:
    return latest(_table(spark, sf, "orders"), ["o_custkey"], "o_orderdate")


@register("""
    SELECT e.* FROM events e JOIN (
        SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id
    ) m ON e.user_id = m.user_id AND e.ts = m.ts
""")
def dedup_latest_events(spark: SparkSession, sf: str) -> DataFrame:
    return latest(_table(spark, sf, "events"), ["user_id"], "ts")


# ---------------------------------------------------------------- top-k lists


def _list(
    spark: SparkSession, sf: str, dim: DataFrame, dim_key: str, fact_key: str, metric: Column,
    attributes: list[str],
) -> DataFrame:
    return top_k_enriched(
        _table(spark, sf, "lineitem"), dim.withColumnRenamed(dim_key, fact_key), key=fact_key,
        metric=metric, name="m", attributes=attributes, time="l_shipdate", low=LOW, high=HIGH,
    )


def _list_sql(metric: str, key: str, dim: str, dim_key: str, attributes: str) -> str:
    return f"""
        SELECT a.{key}, a.m, {attributes} FROM (
            SELECT {key}, {metric} AS m FROM lineitem WHERE {IN_WINDOW}
            GROUP BY {key} ORDER BY m DESC, {key} LIMIT 10
        ) a JOIN {dim} b ON a.{key} = b.{dim_key}
    """


SUPPLIER = ("l_suppkey", "supplier", "s_suppkey", "s_name, s_acctbal")
PART = ("l_partkey", "part", "p_partkey", "p_name, p_retailprice")


@register(_list_sql("count(l_orderkey)", *SUPPLIER))
def top_suppliers_by_count(spark: SparkSession, sf: str) -> DataFrame:
    return _list(spark, sf, _table(spark, sf, "supplier"), "s_suppkey", "l_suppkey",
                 F.count("l_orderkey"), ["s_name", "s_acctbal"])


@register(_list_sql("avg(l_quantity)", *SUPPLIER))
def top_suppliers_by_avg(spark: SparkSession, sf: str) -> DataFrame:
    return _list(spark, sf, _table(spark, sf, "supplier"), "s_suppkey", "l_suppkey",
                 F.avg("l_quantity"), ["s_name", "s_acctbal"])


@register(_list_sql("count(l_orderkey)", *PART))
def top_parts_by_count(spark: SparkSession, sf: str) -> DataFrame:
    return _list(spark, sf, _table(spark, sf, "part"), "p_partkey", "l_partkey",
                 F.count("l_orderkey"), ["p_name", "p_retailprice"]).orderBy("m")


@register(_list_sql("avg(l_quantity)", *PART))
def top_parts_by_avg(spark: SparkSession, sf: str) -> DataFrame:
    return _list(spark, sf, _table(spark, sf, "part"), "p_partkey", "l_partkey",
                 F.avg("l_quantity"), ["p_name", "p_retailprice"]).orderBy("m")


@register(_list_sql("count(l_orderkey)", "l_suppkey",
                    "(SELECT * FROM supplier WHERE s_suppkey % 2 = 0)", "s_suppkey",
                    "s_name, s_acctbal"))
def topk_then_join_shrinks(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension without some of the listed keys: the list shrinks, nothing moves up."""
    partial = _table(spark, sf, "supplier").where("s_suppkey % 2 = 0")
    return _list(spark, sf, partial, "s_suppkey", "l_suppkey",
                 F.count("l_orderkey"), ["s_name", "s_acctbal"])


# ---------------------------------------------------------------- keys in both lists


def _nation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Line count and average quantity in the window per nation of the customer.

    Lines are added up per order, and orders per customer, before each join: only sums are
    shuffled, and a customer or an order with very many lines is one row by then.
    """
    def totals(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(*(F.sum(c).alias(c) for c in ("n", "total", "rated")))

    per_order = (
        in_open_window(_table(spark, sf, "lineitem"), "l_shipdate", LOW, HIGH)
        .groupBy("l_orderkey")
        .agg(
            F.count("l_orderkey").alias("n"),
            F.sum("l_quantity").alias("total"),
            F.count("l_quantity").alias("rated"),
        )
    )
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = _table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_customer = totals(
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), "o_custkey"
    )
    per_nation = totals(
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")), "c_nationkey"
    )
    return per_nation.select(
        "c_nationkey", F.try_divide("total", "rated").alias("mean"), F.col("n").alias("m")
    )


BEST_NATIONS_SQL = """
    WITH fact AS (
        SELECT c_nationkey, l_orderkey, l_quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey WHERE {window}
    ), by_mean AS (
        SELECT c_nationkey, avg(l_quantity) AS mean FROM fact
        GROUP BY c_nationkey ORDER BY mean DESC, c_nationkey LIMIT 10
    ), by_count AS (
        SELECT c_nationkey, count(l_orderkey) AS m FROM fact
        GROUP BY c_nationkey ORDER BY m DESC, c_nationkey LIMIT 10
    )
    SELECT r.c_nationkey, {mean} AS mean, c.m, n.n_name
    FROM by_mean r JOIN by_count c ON r.c_nationkey = c.c_nationkey
    JOIN nation n ON n.n_nationkey = r.c_nationkey
"""


@register(BEST_NATIONS_SQL.format(window=IN_WINDOW, mean="r.mean"))
def best_nations(spark: SparkSession, sf: str) -> DataFrame:
    metrics = _nation_metrics(spark, sf)
    nations = _table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    by_mean = enrich(
        top_k(metrics, "c_nationkey", "mean").drop("m"), nations, "c_nationkey", ["n_name"], 10
    )
    by_count = top_k(metrics, "c_nationkey", "m")
    return best_of(by_mean, by_count, "c_nationkey", "m")


@register(BEST_NATIONS_SQL.format(window=IN_WINDOW, mean="CAST(round_even(r.mean, 0) AS BIGINT)"))
def best_books_bigint(spark: SparkSession, sf: str) -> DataFrame:
    """The average stored in an integer column, rounded half to even."""
    return best_nations(spark, sf).withColumn("mean", F.bround("mean").cast("bigint"))


NATIONS = TableSpec(
    "best", struct(nation_key=LONG, average=DOUBLE, lines=LONG, nation=TEXT), key="nation_key"
)


@register(f"""
    WITH best AS ({BEST_NATIONS_SQL.format(window=IN_WINDOW, mean="r.mean")})
    SELECT CAST(c_nationkey AS BIGINT) AS nation_key, mean AS average, m AS lines,
           n_name AS nation
    FROM (SELECT * FROM best UNION ALL SELECT * FROM best)
""")
def insert_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends by position, from columns that are named differently than the table's."""
    tables = _database(spark, "insert_append").create(NATIONS)
    rows = best_nations(spark, sf).select("c_nationkey", "mean", "m", "n_name")
    for _ in range(2):
        tables.append("best", rows)
    return tables.read("best")


# ---------------------------------------------------------------- windows and checks


@register(f"SELECT count(*) AS n FROM lineitem WHERE {IN_WINDOW}")
def window_open_count(spark: SparkSession, sf: str) -> DataFrame:
    inside = in_open_window(_table(spark, sf, "lineitem"), "l_shipdate", LOW, HIGH)
    return inside.agg(F.count("*").alias("n"))


@register("""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def dq_unique_key(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(" UNION ALL ".join(
    f"SELECT '{name}' AS t, count(*) AS n FROM {name}"
    for name in ("customer", "supplier", "part", "lineitem")
))
def dq_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        name: _table(spark, sf, name) for name in ("customer", "supplier", "part", "lineitem")
    }
    require_rows(tables)
    return row_counts(tables)


@register("""
    SELECT 'rows' AS what, count(*) + (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) AS n
    FROM orders
    UNION ALL
    SELECT 'repeated keys', count(*) FROM orders WHERE o_orderkey % 3 = 0
""")
def dq_collected_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Checks on a table in parts, after a batch that repeats its keys."""
    orders = _table(spark, sf, "orders")
    twice = orders.where("o_orderkey % 3 = 0")
    tables = _database(spark, "checked", parts=4).create(ORDERS)
    tables.replace("orders", orders)
    tables.upsert("orders", twice.unionAll(twice))
    if tables.is_empty("orders"):
        raise EmptyTableError("orders has no rows")
    rows = tables.read("orders")
    repeated = duplicate_keys(rows, [ORDERS.key]).agg(F.count("*").alias("n"))
    return row_counts({"rows": rows}).withColumnRenamed("t", "what").unionAll(
        repeated.select(F.lit("repeated keys"), "n")
    )


# ---------------------------------------------------------------- text and legacy dates


@register(f"""
    SELECT doc_id, trim(regexp_replace(text, '{WHITESPACE_SQL}', ' ', 'g')) AS t
    FROM documents
""")
def normalize_ws(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select("doc_id", collapse_whitespace("text").alias("t"))


def _legacy_text(column: str) -> Column:
    return F.concat(
        F.date_format(column, "EEE MMM dd HH:mm:ss"), F.lit(" -0700 "),
        F.date_format(column, "yyyy"),
    )


@register("SELECT event_id, date_trunc('second', ts) AS t FROM events")
def parse_legacy_ts(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events").select("event_id", _legacy_text("ts").alias("text"))
    return events.select("event_id", legacy_timestamp("text").alias("t"))


@register("""
    SELECT event_type, count(*) AS n,
           CAST(sum(CASE WHEN event_id % 5 IN (1, 2, 3) THEN 1 ELSE 0 END) AS BIGINT) AS invalid,
           CAST(sum(CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END) AS BIGINT) AS empty
    FROM events GROUP BY event_type
""")
def parse_legacy_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """Texts spoiled in three ways, and nulls: null dates, of which only the former count."""
    text = _legacy_text("ts")
    fault = F.col("event_id") % 5
    spoiled = (
        F.when(fault == 1, F.replace(text, F.lit(":"), F.lit("-")))
        .when(fault == 2, F.substring_index(text, " ", 3))
        .when(fault == 3, F.concat_ws(" ", F.lit("Xxx Foo"), F.substring(text, 9, 60)))
        .when(fault == 4, F.lit(None).cast("string"))
        .otherwise(text)
    )
    events = _table(spark, sf, "events").select("event_type", spoiled.alias("text"))
    return events.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_if(legacy_timestamp_invalid("text")).alias("invalid"),
        F.count_if(F.col("text").isNull()).alias("empty"),
    )


# ---------------------------------------------------------------- cleaning jobs


@register(f"""
    SELECT d.doc_id, trim(regexp_replace(d.text, '{WHITESPACE_SQL}', ' ', 'g')) AS text,
           d.lang, d.source, d.n_chars
    FROM documents d JOIN (
        SELECT lang, source, max(n_chars) AS n_chars FROM documents GROUP BY lang, source
    ) m ON d.lang = m.lang AND d.source = m.source AND d.n_chars = m.n_chars
""")
def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    newest = latest(_table(spark, sf, "documents"), ["lang", "source"], "n_chars")
    return newest.withColumn("text", collapse_whitespace("text"))


@register("""
    SELECT e.event_id, e.user_id, date_trunc('second', e.ts) AS ts FROM events e JOIN (
        SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id
    ) m ON e.user_id = m.user_id AND e.ts = m.ts
""")
def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    newest = latest(_table(spark, sf, "events"), ["user_id"], "ts")
    return newest.select(
        "event_id", "user_id", legacy_timestamp(_legacy_text("ts")).alias("ts")
    )


# ---------------------------------------------------------------- upsert


UPSERT_ORDERS_SQL = """
    SELECT * FROM orders WHERE o_orderkey % 3 <> 0
    UNION ALL
    SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL
    SELECT -o_orderkey, o_custkey, 'N' AS o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders WHERE o_orderkey % 3 = 0
"""


def _upsert_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All orders, and a batch: a third of them changed, and as many under new keys."""
    orders = _table(spark, sf, "orders")
    some = orders.where("o_orderkey % 3 = 0")
    changed = some.withColumn("o_orderstatus", F.lit("U"))
    new = some.withColumn("o_orderstatus", F.lit("N")).withColumn("o_orderkey", -F.col("o_orderkey"))
    return orders, changed.unionByName(new)


@register(UPSERT_ORDERS_SQL)
def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    target, batch = _upsert_sides(spark, sf)
    return upsert(target, batch, ["o_orderkey"])


ORDERS = TableSpec(
    "orders",
    struct(
        o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=DOUBLE,
        o_orderdate=TIME, o_orderpriority=TEXT,
    ),
    key="o_orderkey",
    distribute_on="o_custkey",
    raw_name="order",
)


@register(UPSERT_ORDERS_SQL)
def upsert_orders_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The same through tables: the batch replaces staging, staging is upserted.

    The tables are read through another object than the one that wrote them.
    """
    target, batch = _upsert_sides(spark, sf)
    staging = _database(spark, "staging").create(ORDERS)
    root = scratch_path(spark, "warehouse")
    warehouse = Database(spark, "warehouse", root).create(ORDERS)
    warehouse.replace("orders", target)
    staging.replace("orders", batch)
    Database(spark, "warehouse", root).upsert("orders", staging.read("orders"))
    return Database(spark, "warehouse", root).read("orders")


@register(UPSERT_ORDERS_SQL)
def upsert_orders_collected(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two batches on a table in parts, the second over the first."""
    target, batch = _upsert_sides(spark, sf)
    warehouse = _database(spark, "warehouse", parts=4).create(ORDERS)
    warehouse.replace("orders", target)
    warehouse.upsert("orders", batch.withColumn("o_orderstatus", F.lit("early")))
    warehouse.upsert("orders", batch)
    return warehouse.read("orders")


@register("""
    SELECT o_custkey, count(o_orderkey) AS n, max(o_orderdate) AS newest
    FROM orders GROUP BY o_custkey
""")
def bucketed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A table bucketed by the grouping key: no shuffle in the aggregation of most keys."""
    return _per_bucketed_key(spark, _table(spark, sf, "orders"), "o_custkey")


def _per_bucketed_key(spark: SparkSession, orders: DataFrame, key: str) -> DataFrame:
    table = BucketedTable(spark, scratch_path(spark, "bucketed"))
    table.write(orders, key, buckets=8, salts=4, sort_by="o_orderdate")
    return merged_over_salts(
        table.read(), key,
        {"n": F.count("o_orderkey"), "newest": F.max("o_orderdate")},
        {"n": F.sum("n"), "newest": F.max("newest")},
    )


@register("""
    SELECT CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS c,
           count(o_orderkey) AS n, max(o_orderdate) AS newest
    FROM orders GROUP BY 1
""")
def bucketed_hot_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The same where one key has a third of the rows, which are dealt over several buckets."""
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
    return _per_bucketed_key(spark, _table(spark, sf, "orders").withColumn("c", hot), "c")


# ---------------------------------------------------------------- changes of tables in parts


def _as_of(days: int, status: str) -> str:
    return f"""o_orderkey, o_custkey, '{status}' AS o_orderstatus, o_totalprice,
        o_orderdate + INTERVAL {days} DAY AS o_orderdate, o_orderpriority"""


@register(f"""
    SELECT * FROM orders WHERE o_orderkey % 997 <> 5
    UNION ALL SELECT {_as_of(1, "U")} FROM orders WHERE o_orderkey % 997 = 5
""")
def upsert_few_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of few keys, done twice under one id: only parts with its keys are rewritten."""
    orders = _table(spark, sf, "orders")
    tables = _database(spark, "parts", parts=64).create(ORDERS)
    tables.replace("orders", orders)
    batch = _later(orders.where("o_orderkey % 997 = 5"), 1, "U")
    for _ in range(2):
        tables.upsert("orders", batch, change="day-1")
    return tables.read("orders")


def _later(orders: DataFrame, days: int, status: str) -> DataFrame:
    moved = F.col("o_orderdate") + F.expr(f"INTERVAL {days} DAY")
    return orders.withColumn("o_orderstatus", F.lit(status)).withColumn("o_orderdate", moved)


@register(f"""
    SELECT * FROM orders WHERE o_orderkey % 3 <> 0
    UNION ALL SELECT {_as_of(10, "new")} FROM orders WHERE o_orderkey % 3 = 0
""")
def upsert_newest_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches in the wrong order of time: a key keeps its newest row."""
    orders = _table(spark, sf, "orders")
    tables = _database(spark, "newest", parts=8).create(ORDERS)
    for batch in (
        _later(orders.where("o_orderkey % 3 = 0"), 10, "new"), orders, _later(orders, -10, "old"),
    ):
        tables.upsert("orders", batch, newest="o_orderdate")
    return tables.read("orders")


@register("SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 5 = 0")
def append_repeated_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs append; the second is done again, as after a failure, and adds nothing."""
    orders = _table(spark, sf, "orders")
    tables = _database(spark, "runs").create(ORDERS)
    some = orders.where("o_orderkey % 5 = 0")
    for run, rows in (("run-1", orders), ("run-2", some), ("run-2", some)):
        tables.append("orders", rows, change=run)
    return tables.read("orders")


@register("""
    SELECT 'orders' AS checked, count(*) AS repeated FROM orders WHERE o_orderkey % 3 = 1
""")
def dq_changed_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated keys counted change by change, each in the parts that it wrote."""
    orders = _table(spark, sf, "orders")
    tables = _database(spark, "counted", parts=16).create(ORDERS)
    repeats = RepeatedKeys(tables)
    tables.replace("orders", orders, change="load")
    repeats.add(tables, "orders", "load")
    both = orders.unionAll(orders)
    for change, batch in (
        ("twice", both.where("o_orderkey % 3 < 2")), ("once", orders.where("o_orderkey % 3 = 0")),
    ):
        tables.upsert("orders", batch, change=change)
        for _ in range(2):
            repeats.add(tables, "orders", change)
    return repeats.read()


# ---------------------------------------------------------------- delimited files


@register("""
    SELECT event_id, date_trunc('milliseconds', ts) AS ts, user_id, event_type, value, props
    FROM events
""")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events")
    path = scratch_path(spark, "csv_roundtrip")
    write_processed(events, path)
    return read_processed(spark, path, events.schema)


@register("""
    SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents
""")
def csv_roundtrip_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Text with line breaks, quotes and separators, written and read back."""
    documents = _table(spark, sf, "documents")
    path = scratch_path(spark, "csv_roundtrip_documents")
    write_processed(documents, path)
    return read_processed(spark, path, documents.schema)


@register("""
    SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars, reader
    FROM documents CROSS JOIN (VALUES ('whole'), ('split')) AS r(reader)
""")
def csv_split_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A drop in large files, a task each, and the same in files of bounded size, dealt out."""
    documents = _table(spark, sf, "documents")
    path = scratch_path(spark, "csv_split_documents")
    for name, rows in (("whole", 0), ("split", 100)):
        documents.write.option("header", True).option("escape", '"').option(
            "maxRecordsPerFile", rows
        ).csv(f"{path}/{name}")
    whole, split = (
        read_delimited(spark, f"{path}/{name}", documents.schema, spread=name == "split")
        for name in ("whole", "split")
    )
    return whole.withColumn("reader", F.lit("whole")).unionAll(
        split.withColumn("reader", F.lit("split"))
    )


@register("""
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
           o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders
""")
def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Column types worked out from the text; numbers take the narrowest fit."""
    path = scratch_path(spark, "csv_inferred")
    _table(spark, sf, "orders").write.option("header", True).csv(path)
    inferred = read_delimited(spark, path, None)
    return inferred.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@register("""
    SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS name,
           CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS nation,
           c_custkey % 3 <> 2 AS malformed, reader
    FROM customer CROSS JOIN (VALUES ('lines'), ('split')) AS r(reader)
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, FALSE, reader FROM customer
    CROSS JOIN (VALUES ('lines, dropping'), ('split, dropping')) AS r(reader)
    WHERE c_custkey % 3 = 2
""")
def csv_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Short records are filled with null, surplus fields dropped, and both are kept apart.

    Or such records are left out; each read by line and as files with line breaks in quotes.
    """
    path = scratch_path(spark, "csv_malformed")
    kind = F.col("c_custkey") % 3
    line = (
        F.when(kind == 0, F.col("c_custkey").cast("string"))
        .when(kind == 1, F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", F.lit("more")))
        .otherwise(F.concat_ws(",", "c_custkey", "c_name", "c_nationkey"))
    )
    _table(spark, sf, "customer").select(line.alias("value")).write.text(path)
    schema = struct(id=LONG, name=TEXT, nation=INT)
    return reduce(DataFrame.unionAll, (
        read_delimited(
            spark, path, schema, header=False, corrupt_column="malformed", mode=mode, **how
        ).select("id", "name", "nation", F.col("malformed").isNotNull().alias("malformed"),
                 F.lit(name + label).alias("reader"))
        for mode, label in (("PERMISSIVE", ""), ("DROPMALFORMED", ", dropping"))
        for name, how in (("lines", {"multi_line": False}), ("split", {"spread": True}))
    ))


CUSTOMERS = TableSpec(
    "customers", struct(id=LONG, name=TEXT, nation=INT, since=TIME), key="id",
    raw_name="customer", raw_text=("since",),
)


@register("""
    SELECT CASE c_custkey % 5 WHEN 0 THEN 'malformed record' WHEN 1 THEN 'malformed record'
            WHEN 2 THEN 'unreadable date in since' ELSE 'accepted' END AS reason,
        CASE c_custkey % 5
            WHEN 0 THEN c_custkey::VARCHAR
            WHEN 1 THEN concat_ws(',', c_custkey, c_name, c_nationkey, 'Sat Jul 04 10:11:12 -0700 2020,more')
            WHEN 2 THEN concat_ws(',', c_custkey, c_name, c_nationkey, 'Sat Jul 44')
            ELSE c_name END AS text
    FROM customer
""")
def quarantined_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Records of three faults beside good ones: each is accepted, or kept with the reason."""
    source = scratch_path(spark, "quarantined")
    kind, date = F.col("c_custkey") % 5, F.lit("Sat Jul 04 10:11:12 -0700 2020")
    three = ("c_custkey", "c_name", "c_nationkey")
    line = (
        F.when(kind == 0, F.col("c_custkey").cast("string"))
        .when(kind == 1, F.concat_ws(",", *three, date, F.lit("more")))
        .when(kind == 2, F.concat_ws(",", *three, F.lit("Sat Jul 44")))
        .otherwise(F.concat_ws(",", *three, date))
    )
    _table(spark, sf, "customer").select(line.alias("value")).write.text(source)
    rejects = _database(spark, "rejects")
    for _ in range(2):
        accepted = read_accepted(spark, source, CUSTOMERS, rejects, "day-1", header=False)
    return accepted.select(F.lit("accepted").alias("reason"), F.col("name").alias("text")).unionAll(
        rejects.read("rejects").select("reason", "text")
    )


@register("""
    SELECT s_suppkey AS author_id, '"the ""' || s_name || '"" author"' AS name FROM supplier
""")
def csv_author_escape(spark: SparkSession, sf: str) -> DataFrame:
    """Doubled quotes read with the backslash as escape: the field keeps its raw quotes."""
    path = scratch_path(spark, "csv_author_escape")
    named = F.concat(F.lit('the "'), "s_name", F.lit('" author'))
    authors = _table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("author_id"), named.alias("name")
    )
    authors.write.option("header", True).option("escape", '"').csv(path)
    return read_delimited(spark, path, authors.schema, escape="\\")


# ---------------------------------------------------------------- incremental pick-up


LANDED_ORDERS = TableSpec(
    "orders",
    StructType([*ORDERS.schema, *struct(drop_ms=LONG)]),
    key="o_orderkey",
    raw_name="order",
    added=("drop_ms",),
)


@register(f"""
    SELECT *, CASE WHEN o_orderstatus IN ('U', 'N') THEN 1596893767990 ELSE 1596807367990 END
        AS drop_ms
    FROM ({UPSERT_ORDERS_SQL})
""")
def landing_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops that arrive one after the other, each picked up once and upserted."""
    target, batch = _upsert_sides(spark, sf)
    landing = scratch_path(spark, "landing")
    checkpoint = scratch_path(spark, "landing_checkpoint")
    staging = _database(spark, "staging").create(LANDED_ORDERS)
    warehouse = _database(spark, "landed").create(LANDED_ORDERS)
    for stamp, drop in ((1596807367990, target), (1596893767990, batch)):
        drop.write.option("header", True).option("maxRecordsPerFile", standins.ROWS_PER_FILE).csv(
            f"{landing}/order_{stamp}.csv"
        )
        ingest(
            spark, landing, LANDED_ORDERS, staging, warehouse, checkpoint,
            clean=lambda rows: latest(rows, ["o_orderkey"], "o_orderdate"),
        )
    return warehouse.read("orders")


UNKEYED_SQL = """
    SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey,
           o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders
"""


def _unkeyed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of which some have no key: these are never replaced, so a repeated load shows."""
    key = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey"))
    return _table(spark, sf, "orders").withColumn("o_orderkey", key)


def _drop(rows: DataFrame, landing: str, stamp: int) -> None:
    rows.write.option("header", True).option("maxRecordsPerFile", standins.ROWS_PER_FILE).csv(
        f"{landing}/order_{stamp}.csv"
    )


@register(UNKEYED_SQL)
def landing_repeated_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that is done, then done again because its end was not noted: it changes nothing."""
    landing, checkpoint = (scratch_path(spark, n) for n in ("landing", "landing_checkpoint"))
    staging, warehouse = (_database(spark, n).create(ORDERS) for n in ("staging", "landed"))
    _drop(_unkeyed(spark, sf), landing, 1596807367990)
    for _ in range(2):
        ingest(spark, landing, ORDERS, staging, warehouse, checkpoint, clean=lambda rows: rows)
        notes = Folders(spark, f"{checkpoint}/commits")
        for name in notes.names():
            notes.delete(name)
    return warehouse.read("orders")


@register(UNKEYED_SQL)
def landing_same_content(spark: SparkSession, sf: str) -> DataFrame:
    """A drop that comes under three names, two at once and one later: it counts once."""
    landing, checkpoint = (scratch_path(spark, n) for n in ("landing", "landing_checkpoint"))
    staging, warehouse = (_database(spark, n).create(ORDERS) for n in ("staging", "landed"))
    rows = _unkeyed(spark, sf)
    for stamps in ((1596807367990, 1596807367991), (1596893767990,)):
        for stamp in stamps:
            _drop(rows, landing, stamp)
        ingest(spark, landing, ORDERS, staging, warehouse, checkpoint, clean=lambda rows: rows)
    return warehouse.read("orders")


# ---------------------------------------------------------------- the whole refresh


def _refreshed(spark: SparkSession, sf: str, k: int = 10) -> tuple[Database, Database]:
    """The warehouse and the analytics tables of a whole refresh."""
    source = scratch_path(spark, "raw")
    standins.write_raw(spark, sf, source)
    warehouse, analytics = _database(spark, "warehouse"), _database(spark, "analytics")
    refresh(
        spark, source=source, processed=scratch_path(spark, "processed"),
        staging=_database(spark, "staging"), warehouse=warehouse, analytics=analytics,
        low=LOW, high=HIGH, k=k,
    )
    return warehouse, analytics


def _labelled(*parts: tuple[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, (df.select(F.lit(name).alias("list"), *df.columns)
                                       for name, df in parts))


@register(standins.LATEST_REVIEWS_SQL + f"""
    , listed AS (
        SELECT author_id, count(review_id) AS m FROM reviews WHERE
        record_create_timestamp > TIMESTAMP '{LOW}'
        AND record_create_timestamp < TIMESTAMP '{HIGH}'
        GROUP BY author_id ORDER BY m DESC, author_id LIMIT 10
    )
    SELECT l.author_id, l.m AS review_count, s.s_name AS name, 'supplier' AS role,
           'https://example.org/author/' || s.s_suppkey AS profile_url,
           s.s_acctbal AS average_rating, s.s_nationkey AS rating_count,
           CAST(NULL AS INTEGER) AS text_review_count,
           TIMESTAMP '2020-07-02 00:00:00' AS record_create_timestamp
    FROM listed l JOIN supplier s ON l.author_id = s.s_suppkey
""")
def refreshed_popular_authors(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files to analytics tables; the most reviewed authors at the end of it."""
    return _refreshed(spark, sf)[1].read(AUTHOR_LISTS.by_count.name)


# Long enough that keys are in both lists at every size of the supplied tables.
LONG_LIST = 100

LISTS_SQL = standins.LATEST_REVIEWS_SQL + f"""
    , windowed AS (
        SELECT * FROM reviews WHERE record_create_timestamp > TIMESTAMP '{LOW}'
        AND record_create_timestamp < TIMESTAMP '{HIGH}'
    ), by_count AS (
        SELECT {{key}} AS id, count(review_id) AS n FROM windowed
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {LONG_LIST}
    ), by_rating AS (
        SELECT {{key}} AS id, avg(review_rating) AS rating FROM windowed
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {LONG_LIST}
    ), best AS (
        SELECT id, rating, n FROM by_rating JOIN by_count USING (id)
    ), lists AS (
        SELECT 'count' AS list, id, CAST(NULL AS DOUBLE) AS rating, n FROM by_count
        UNION ALL SELECT 'rating', id, rating, NULL FROM by_rating
        UNION ALL SELECT 'best', id, rating, n FROM best
        {{more}}
    )
    SELECT list, id, rating, n, {{name}} AS name FROM lists JOIN {{dim}} ON id = {{dim_key}}
"""


def _lists_of(analytics: Database, lists: KeyLists, name: str) -> list[tuple[str, DataFrame]]:
    """The three tables of a key, each with all of: id, rating, number of reviews, name."""
    found = []
    for label, spec in (("count", lists.by_count), ("rating", lists.by_rating),
                        ("best", lists.best)):
        has = spec.columns
        found.append((label, analytics.read(spec.name).select(
            F.col(lists.key).alias("id"),
            F.col(lists.rating).cast("double").alias("rating")
            if lists.rating in has else F.lit(None).cast("double").alias("rating"),
            F.col("review_count").alias("n")
            if "review_count" in has else F.lit(None).cast("long").alias("n"),
            F.col(name).alias("name"),
        )))
    return found


@register(LISTS_SQL.format(
    key="author_id", more="", name="s_name", dim="supplier", dim_key="s_suppkey"
))
def refreshed_best_rated_authors(spark: SparkSession, sf: str) -> DataFrame:
    """The three author tables after a refresh with long lists, one below the other."""
    _, analytics = _refreshed(spark, sf, LONG_LIST)
    return _labelled(*_lists_of(analytics, AUTHOR_LISTS, "name"))


@register(LISTS_SQL.format(
    key="book_id", name="p_name", dim="part", dim_key="p_partkey",
    more="UNION ALL SELECT 'best in whole numbers', id, round_even(rating, 0), n FROM best",
))
def refreshed_book_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The three book tables after a refresh with long lists, the shared one in both its types.

    The second refresh of the lists finds a shared table with an integer average.
    """
    warehouse, analytics = _refreshed(spark, sf, LONG_LIST)
    whole = _database(spark, "analytics").create(
        BOOK_LISTS.by_count, BOOK_LISTS.by_rating, BEST_BOOKS_INTEGER
    )
    refresh_lists(warehouse, whole, BOOK_LISTS, LOW, HIGH, k=LONG_LIST)
    *_, (_, rounded) = _lists_of(whole, BOOK_LISTS, "title")
    return _labelled(
        *_lists_of(analytics, BOOK_LISTS, "title"), ("best in whole numbers", rounded)
    )


# ---------------------------------------------------------------- day by day


@register(LISTS_SQL.format(
    key="author_id", more="", name="s_name", dim="supplier", dim_key="s_suppkey"
))
def refreshed_daily_authors(spark: SparkSession, sf: str) -> DataFrame:
    """The author tables after two days, each of which reads its own drops and no others.

    Old versions come after new ones.
    """
    landing, checkpoint = (scratch_path(spark, n) for n in ("landing", "daily_checkpoint"))
    staging = _database(spark, "staging", parts=0)
    warehouse, analytics = _database(spark, "warehouse", parts=8), _database(spark, "analytics")
    for day in range(2):
        standins.write_raw_day(spark, sf, landing, day)
        refresh_new(
            spark, landing=landing, checkpoint=checkpoint, staging=staging, warehouse=warehouse,
            analytics=analytics, low=LOW, high=HIGH, k=LONG_LIST,
        )
    return _labelled(*_lists_of(analytics, AUTHOR_LISTS, "name"))


CUT_LOW, CUT_HIGH = "1994-03-05 07:30:00", "1995-11-20 15:45:10"

TIMED_REVIEWS_SQL = """
    SELECT l_orderkey * 10 + l_linenumber AS review_id, l_partkey AS book_id,
           l_quantity AS review_rating,
           l_shipdate + INTERVAL (l_orderkey % 86400) SECOND AS record_create_timestamp
    FROM lineitem
"""


@register(f"""
    WITH raw AS ({TIMED_REVIEWS_SQL}), changed AS (
        SELECT review_id, book_id % 7 AS book_id, review_rating + 1,
               record_create_timestamp + INTERVAL 36 HOUR
        FROM raw WHERE review_id % 4 = 0
    ), now AS (
        SELECT * FROM raw WHERE review_id % 4 <> 0 UNION ALL SELECT * FROM changed
    )
    SELECT book_id, count(review_id) AS review_count, avg(review_rating) AS average_reviews_rating
    FROM now WHERE record_create_timestamp > TIMESTAMP '{CUT_LOW}'
    AND record_create_timestamp < TIMESTAMP '{CUT_HIGH}' GROUP BY book_id
""")
def window_from_daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A window from daily totals, after an upsert that moved reviews to other books and days."""
    moment = F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_orderkey") % 86400)
    base = _table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
        F.col("l_partkey").alias("book_id"), F.col("l_quantity").alias("review_rating"),
        moment.alias("record_create_timestamp"),
    )
    later = F.col("record_create_timestamp") + F.expr("INTERVAL 36 HOUR")
    changed = base.where("review_id % 4 = 0").withColumns({
        "book_id": F.col("book_id") % 7, "review_rating": F.col("review_rating") + 1,
        "record_create_timestamp": later,
    })
    warehouse = _database(spark, "totals", parts=8).create(REVIEWS)
    totals = DailyTotals(warehouse, BOOK_LISTS)
    for change, rows in (("load", base), ("moved", changed)):
        filled = rows.select(*(
            F.col(f.name) if f.name in rows.columns else F.lit(None).alias(f.name)
            for f in REVIEWS.schema
        ))
        warehouse.upsert("reviews", filled, change=change)
        totals.add(warehouse, change)
    return totals.metrics(warehouse.read("reviews"), CUT_LOW, CUT_HIGH)


@register("""
    SELECT l_partkey, count(l_orderkey) AS n FROM lineitem
    GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 25
""")
def top_parts_counted(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent keys; groups of keys that cannot be among them are not shuffled."""
    return top_k_counted(_table(spark, sf, "lineitem"), "l_partkey", "l_orderkey", "n", 25)

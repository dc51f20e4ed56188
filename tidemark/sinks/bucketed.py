"""A table in buckets of one column, of which frequent values have several."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sinks.folders import Folders

SALT = "salt"
SPEC = "_spec.json"
BUCKETS = 64
SALTS = 16
# Values that the sketch follows, for each bucket.
TRACKED = 16


class BucketedTable:
    """Rows below ``path`` in buckets by (column, salt): a layout, as Spark's catalog knows it.

    The salt of most rows is 0, so a value's rows are in one bucket and an aggregation by column
    and salt needs no shuffle. A value with more rows than a bucket's fair share is found by a
    sketch when the table is written, and its rows are dealt over ``salts`` salts (1, 2, ...), so
    over as many buckets: no bucket, and so no task, holds much more than the others.
    ``merged_over_salts`` aggregates such a table.

    The folder holds all that a session needs; its catalog entry is made where it is read.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def write(
        self, df: DataFrame, column: str, *, buckets: int = BUCKETS, salts: int = SALTS,
        sort_by: str | None = None,
    ) -> list:
        """Writes the rows to an unused folder; returns the values that were dealt out."""
        if SALT in df.columns:
            raise ValueError(f"a column is named {SALT} already")
        found = df.where(F.col(column).isNotNull()).agg(
            F.expr(f"approx_top_k(`{column}`, {buckets}, {TRACKED * buckets})").alias("found"),
            F.count("*").alias("n"),
        ).first()
        # Fewer than the number of buckets; the sketch never counts a value too low.
        heavy = [item[0] for item in found["found"] or () if item[1] > found["n"] / buckets]
        dealt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int") + 1
        salted = df.withColumn(
            SALT, F.when(F.col(column).isin(heavy), dealt).otherwise(0) if heavy else F.lit(0)
        )
        held = {
            "schema": json.loads(salted.schema.json()), "column": column, "buckets": buckets,
            "sort_by": sort_by,
        }
        # As many hash partitions as buckets: a task writes whole buckets.
        salted.repartition(buckets, column, SALT).write.insertInto(self._entry(held))
        Folders(self.spark, self.path).put(SPEC, json.dumps(held))
        return heavy

    def read(self) -> DataFrame:
        held = json.loads(Folders(self.spark, self.path).text(SPEC))
        return self.spark.table(self._entry(held))

    def _entry(self, held: dict) -> str:
        name = f"`bucketed_{hashlib.md5(self.path.encode()).hexdigest()}`"
        schema = StructType.fromJson(held["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        order = f", `{held['sort_by']}`" if held["sort_by"] else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{held['column']}`, `{SALT}`) SORTED BY (`{SALT}`{order}) "
            f"INTO {held['buckets']} BUCKETS LOCATION '{self.path}'"
        )
        return name


def merged_over_salts(
    table: DataFrame, column: str, partial: dict[str, Column], merge: dict[str, Column]
) -> DataFrame:
    """An aggregation by ``column``: ``partial`` by column and salt, then ``merge`` over salts.

    ``merge`` gives each name from the partial column of that name (a sum of counts, a maximum of
    maxima). Rows of salt 0 are final after the first step, which shuffles nothing; the second
    shuffles one row per salt of the frequent values.
    """
    def parts(salted: Column) -> DataFrame:
        return table.where(salted).groupBy(column, SALT).agg(
            *(c.alias(name) for name, c in partial.items())
        )

    light = parts(F.col(SALT) == 0).select(column, *partial)
    heavy = parts(F.col(SALT) > 0).groupBy(column).agg(
        *(c.alias(name) for name, c in merge.items())
    ).select(column, *partial)
    return light.unionAll(heavy)

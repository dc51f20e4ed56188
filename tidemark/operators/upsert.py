"""Replace by key: rows of a batch take the place of the rows that have their key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Copies of one key that may remain in the key list of a batch.
LANES = 16


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name, in its order and types; other columns are an error."""
    missing = [c for c in schema.names if c not in df.columns]
    surplus = [c for c in df.columns if c not in schema.names]
    if missing or surplus:
        raise ValueError(f"columns do not fit the table: missing {missing}, surplus {surplus}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def _claimed(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of a batch, thinned to at most LANES copies of each before the shuffle.

    Thinning to one copy would leave them partitioned by key, and the target's side of a join could
    then no longer be split at a hot key.
    """
    lane = F.spark_partition_id() % LANES
    return staging.select(*keys, lane.alias("_lane")).distinct().drop("_lane")


def upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the keys of ``staging``, and all rows of ``staging``.

    The batch wins whatever the versions. Keys repeated in the batch are all inserted; a null
    key matches nothing, so such rows of either side stay.
    """
    kept = target.join(_claimed(staging, keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(align(staging, target.schema))


def upsert_newest(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], version: str
) -> DataFrame:
    """Per key of ``staging`` the rows of either side with the highest ``version``.

    Other keys stay as they are. So batches may come in any order, and give together what
    ``latest`` gives of all their rows. Rows tied at the highest version are all kept, and a null
    version is lower than any. A null key matches nothing, so such rows of either side stay.
    """
    found = outdated(target, staging, keys, version)
    return without_outdated(target, staging, found, keys, version)


def _sides(target: DataFrame, staging: DataFrame) -> DataFrame:
    batch = align(staging, target.schema)
    return target.withColumn("_new", F.lit(False)).unionAll(batch.withColumn("_new", F.lit(True)))


def outdated(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], version: str
) -> DataFrame:
    """The highest version of the keys of ``staging`` that several rows of both sides have.

    Only such keys can have rows that ``upsert_newest`` leaves out. Found from keys and versions
    alone, combined before the shuffle.
    """
    has_key = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    found = _sides(target, staging).where(has_key).groupBy(*keys).agg(
        # The key as a value: a join on it deals these rows out anew, and only then can adaptive
        # execution split the other side at a hot key.
        *(F.max(k).alias(f"_{k}") for k in keys),
        F.max(version).alias("_highest"),
        F.count("*").alias("_rows"),
        F.bool_or("_new").alias("_claimed"),
    )
    return found.where("_claimed and _rows > 1").select(*(f"_{k}" for k in keys), "_highest")


def without_outdated(
    target: DataFrame, staging: DataFrame, found: DataFrame, keys: Sequence[str], version: str
) -> DataFrame:
    """All rows of both sides but those that ``found``, from ``outdated``, says are older.

    Where it is known to be small, Spark broadcasts it and the rows are not shuffled.
    """
    older = ~F.col(version).eqNullSafe(F.col("_highest"))
    for key in keys:
        older = older & (F.col(key) == F.col(f"_{key}"))
    return _sides(target, staging).join(found, older, "left_anti").select(*target.columns)

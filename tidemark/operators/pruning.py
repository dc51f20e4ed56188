"""Top-k by count with most keys left out before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import key_metrics, top_k

# Groups of keys that are counted together; their counts go through the driver.
GROUPS = 1 << 16
# Keys that the sketch follows, for each of the k asked for.
TRACKED = 64


def top_k_counted(
    fact: DataFrame, key: str, counted: str, name: str, k: int = 10, groups: int = GROUPS
) -> DataFrame:
    """``top_k`` of ``count(counted)`` per key: the same rows, from a smaller shuffle.

    Passes over two columns. A sketch proposes frequent keys, and the k-th highest of their exact
    counts is a bound that the k-th place reaches. Keys are then counted in ``groups`` by hash: no
    key has more than its group, so groups below the bound hold no listed key. Only rows of the
    other groups are aggregated by key and shuffled. A null key is a group of its own, as in
    ``key_metrics``. It pays where few keys are frequent; with equal counts nothing is left out.
    """
    if k < 1:
        return top_k(key_metrics(fact, key, **{name: F.count(counted)}), key, name, k)
    group = F.pmod(F.xxhash64(key), F.lit(groups))
    rows = fact.select(key, counted).where(F.col(counted).isNotNull())
    proposed = rows.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {max(TRACKED * k, 1024)})").alias("found")
    ).first()["found"]
    keys = [item[0] for item in proposed or ()]  # at most k
    bound = 0
    if len(keys) == k:
        exact = rows.where(F.col(key).isin(keys)).groupBy(key).count().agg(F.min("count"))
        bound = exact.first()[0]
    # At most ``groups`` numbers, of which those that reach the bound are at most rows / bound.
    reached = [
        r["g"] for r in rows.groupBy(group.alias("g")).count().where(
            F.col("count") >= bound).select("g").collect()
    ] if bound else None
    if reached is not None and len(reached) < groups:
        small = fact.sparkSession.createDataFrame([(g,) for g in reached], "_group long")
        kept = fact.withColumn("_group", group).join(
            F.broadcast(small), "_group", "left_semi"
        ).drop("_group")
    else:
        kept = fact
    return top_k(key_metrics(kept, key, **{name: F.count(counted)}), key, name, k)

"""Session settings the operators are designed around, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it turns a shuffle join into a broadcast one
# once the measured size of a side allows it, it splits the partition of a hot key, and it
# merges small partitions, so shuffle.partitions can be set for the largest table.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder in ``spark.checkpoint.dir``.

    A cluster must name that folder: every executor has to see it. Only a local session may
    leave it out, and then gets a temporary folder for the life of the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"

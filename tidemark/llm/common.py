"""Helpers shared by the operators: column choice, shared scratch tables, words and shingles."""

from __future__ import annotations

import uuid
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_BATCH_BYTES = "67108864b"
BATCH_BYTES = "2m"
NO_ID = np.iinfo(np.int64).max


def take(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever other columns (same name in other case, repeats) there are.

    A name is matched by its exact spelling; of repeated names the first counts.
    """
    columns = df.columns
    missing = [name for name in names if name not in columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {columns}")
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.select(*[F.col(f"c{columns.index(name)}").alias(name) for name in names])


def texts(df: DataFrame, *carry: str) -> DataFrame:
    """doc_id as long, text with null as empty, then the carried columns as k0, k1, ...

    Bounds the session's Arrow batches, on their way into Python tasks, to BATCH_BYTES where it
    leaves them at Spark's default, so that a task holds little more than one long text.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == SPARKS_BATCH_BYTES:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    rows = take(df, "doc_id", "text", *[name for name in carry])
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *[F.col(name).alias(f"k{i}") for i, name in enumerate(carry)],
    ) if len(set(carry) & {"doc_id", "text"}) == 0 else _refuse(carry)


def _refuse(carry):
    raise ValueError(f"doc_id and text are carried anyway: {carry}")


def restored(df: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Undoes the renaming of the carried columns."""
    return df.withColumnsRenamed({f"k{i}": name for i, name in enumerate(carry)})


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_words(text: str | None) -> list[bytes]:
    """The maximal runs of characters other than space and tab to carriage return, in UTF-8."""
    return text.encode().split() if text else []


def hashes(parts: list[bytes], seed: int = 0) -> np.ndarray:
    """XXH64 of each part."""
    found = map(xxhash.xxh64_intdigest, parts, repeat(seed))
    return np.fromiter(found, dtype=np.uint64, count=len(parts))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``width`` word hashes, modulo 2**64, then scrambled.

    Sums of h[j] * BASE**j give every window as a difference of two; multiplying by a power of
    BASE (odd, so it can be divided out) moves all windows to one exponent.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        up = np.full(len(h), BASE, np.uint64)
        up[0] = 1
        up = np.multiply.accumulate(up)
        down = np.full(n, pow(BASE, -1, 2**64), np.uint64)
        down[0] = 1
        down = np.multiply.accumulate(down)
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up, out=sums[1:])
        return mixed((sums[width:] - sums[:-width]) * down)


def binary(arrays) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())

"""Centroid clustering: exact rounds over Hilbert-ordered blocks of vectors with min/max boxes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import take, written

SIZE = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
BITS = 2
BLOCK_ROWS = 128
# Larger components are cut to this, so that squared distances fit 63 bits.
LARGEST = 1 << 27
# Below this, products are summed exactly in double precision.
EXACT_IN_DOUBLE = 1 << 22


def hilbert(cells: np.ndarray, bits: int) -> list[bytes]:
    """The place of each row of cells (0 to 2 ** bits - 1) on the Hilbert curve, as sortable bytes.

    Skilling's transform: from the highest bit down, the curve of a subcube is the whole curve
    reflected (invert the first axis) or turned (exchange two axes), then a Gray code.
    """
    x = cells.astype(np.uint32)
    first, last = 0, x.shape[1] - 1
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for axis in range(x.shape[1]):
            turned = (x[:, axis] >> bit) & 1 == 1
            swap = np.where(turned, 0, (x[:, first] ^ x[:, axis]) & low)
            x[:, first] ^= np.where(turned, low, swap)
            x[:, axis] ^= swap
    for axis in range(1, x.shape[1]):
        x[:, axis] ^= x[:, axis - 1]
    flip = np.zeros(len(x), np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, last] >> bit) & 1 == 1, (1 << bit) - 1, 0).astype(np.uint32)
    x ^= flip[:, None]
    planes = [(x >> bit) & 1 for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that may be nearest to some point of a box, ascending.

    One is left out if even its closest point of the box is farther than another centroid is
    from the farthest point of the box.
    """
    inside = np.maximum(0, np.maximum(low - centroids, centroids - high))
    outside = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    return np.flatnonzero((inside**2).sum(axis=1) <= (outside**2).sum(axis=1).min())


def assign(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row of x (integers) the nearest centroid, ties to the first, and its distance."""
    maybe = candidates(x.min(axis=0), x.max(axis=0), centroids)
    near = centroids[maybe]
    if max(np.abs(x).max(), np.abs(near).max()) < EXACT_IN_DOUBLE:
        a, b = x.astype(np.float64), near.astype(np.float64)
        squared = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        squared = squared.astype(np.int64)
    else:
        squared = np.stack([((x - c) ** 2).sum(axis=1) for c in near], axis=1)
    best = squared.argmin(axis=1)
    return maybe[best], squared[np.arange(len(x)), best]


def _kept(vectors: DataFrame, id_column: str, vector_column: str, size: int) -> DataFrame:
    vector = F.col("vector")
    bad = F.exists(
        vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    )
    return take(vectors, id_column, vector_column).toDF("id", "vector").select(
        F.col("id").cast("long").alias("id"), vector.cast("array<double>").alias("vector")
    ).filter((F.size("vector") == size) & ~bad)


def _integers(column, size: int, scale: int) -> np.ndarray:
    x = np.asarray(column.flatten(), np.float64).reshape(-1, size)
    return np.clip(np.floor(scale * x), -LARGEST, LARGEST).astype(np.int32)


def blocks(
    kept: DataFrame, size: int = SIZE, scale: int = SCALE, rows: int = BLOCK_ROWS,
    bits: int = BITS,
) -> DataFrame:
    """ids, x (int32, row by row) of up to ``rows`` vectors that follow each other on the curve.

    Axes are taken by falling variance and cut into cells by mean and standard deviation, both
    over all vectors. Copies of one vector are spread by their id, so many of them are many
    partitions.
    """
    stats = kept.agg(*(
        f(F.col("vector")[i]) for i in range(size) for f in (F.avg, F.stddev_pop)
    )).first()
    mean, spread = (np.array([s or 0.0 for s in stats[i::2]]) for i in (0, 1))
    mean, spread = np.nan_to_num(mean), np.nan_to_num(spread)
    order = np.argsort(-spread, kind="stable")
    width = np.where(spread > 0, spread, 1) * 2.0 ** (2 - bits)

    def place(batches):
        for batch in batches:
            vectors = np.asarray(batch.column("vector").flatten(), np.float64).reshape(-1, size)
            cells = np.floor((vectors - mean) / width)[:, order] + (1 << (bits - 1))
            cells = np.clip(cells, 0, (1 << bits) - 1)
            x = _integers(batch.column("vector"), size, scale)
            yield pa.record_batch(
                [batch.column("id"), pa.array(hilbert(cells, bits), pa.binary()),
                 pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "place", "x"],
            )

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield pa.record_batch(
                    [pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([b"".join(part.column("x").to_pylist())], pa.binary())],
                    names=["ids", "x"],
                )

    spread_on = ("place", F.xxhash64("id", "x"))
    placed = kept.mapInArrow(place, "id long, place binary, x binary")
    return placed.repartitionByRange(*spread_on).sortWithinPartitions(*spread_on).mapInArrow(
        cut, "ids array<long>, x binary"
    )


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "3:",
    id_column: str = "vec_id", vector_column: str = "embedding", size: int = SIZE,
    scale: int = SCALE, rows_per_block: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Vectors with exactly ``size`` components, none null or non-finite, become integers
    floor(scale * x), cut to +-LARGEST. The centroids begin as the vectors with the smallest
    sha256 of ``seed`` and the id (null ids last; of equal ids the smaller vector first), as many
    as there are. Every round assigns each vector to the nearest one (ties: the smaller number)
    and replaces those that have vectors by the exact floor(sum / count) of each component; rounds
    that change nothing any more are not run. Then vectors are assigned once more.

    Vectors lie in blocks along a Hilbert curve. A block's box bounds its distance to each
    centroid from both sides, and only centroids that some point of the box may be nearest to are
    compared, exactly, with its vectors. Null ids and repeated rows are vectors like any other.
    Vectors that are not kept have no row; an empty table gives no rows. Only centroids, their
    sums and inertias pass through the driver.
    """
    spark = vectors.sparkSession
    kept = _kept(vectors, id_column, vector_column, size)
    first = kept.orderBy(
        F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256).asc_nulls_last(), "vector"
    ).limit(clusters).toArrow()
    result = (
        "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
        "centroid_sha256 string"
    )
    if not first.num_rows:
        return spark.createDataFrame([], result)
    centroids = _integers(first["vector"].combine_chunks(), size, scale).astype(np.int64)
    table = written(blocks(kept, size, scale, rows_per_block), "blocks")

    def moved(now: np.ndarray) -> np.ndarray:
        def total(batches):
            n, sums = np.zeros(len(now), np.int64), np.zeros(now.shape, np.int64)
            for batch in batches:
                for raw in batch.column("x"):
                    x = np.frombuffer(raw.as_buffer(), np.int32).reshape(-1, size).astype(np.int64)
                    own, _ = assign(x, now)
                    for c in np.unique(own):
                        n[c] += (own == c).sum()
                        sums[c] += x[own == c].sum(axis=0)
            yield pa.record_batch(
                [pa.array(np.arange(len(now)), pa.int32()), pa.array(n),
                 pa.array(sums.tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"],
            )

        parts = table.select("x").mapInArrow(total, "cluster int, n long, sums array<long>")
        new = now.copy()
        added = parts.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(
            F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s")
        ).filter("n > 0")
        for row in added.collect():  # at most clusters * size rows
            new[row["cluster"], row["pos"]] = int(row["s"]) // row["n"]
        return new

    for _ in range(rounds):
        before, centroids = centroids, moved(centroids)
        if (before == centroids).all():
            break

    def final(batches):
        for batch in batches:
            for ids, raw in zip(batch.column("ids"), batch.column("x")):
                x = np.frombuffer(raw.as_buffer(), np.int32).reshape(-1, size).astype(np.int64)
                own, distance = assign(x, centroids)
                yield pa.record_batch(
                    [ids.values, pa.array(own, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    assigned = written(
        table.mapInArrow(final, "vec_id long, cluster int, distance long"), "assigned"
    )
    inertia = {
        r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
            F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")
        ).collect()
    }
    about = spark.createDataFrame([
        (c, s, sum(inertia.values()),
         hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, s in inertia.items()
    ], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

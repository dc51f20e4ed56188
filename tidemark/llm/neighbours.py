"""Approximate nearest neighbours: a forest of random-projection trees, then exact reranking."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import take

TREES = 16
DEPTH = 8
SAMPLE = 16_384
SMALLEST_LEAF = 32
VISITED = 1 / 12
VECTORS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 4096


class Forest:
    """Complete trees; node i of a tree has the children 2 i + 1 and 2 i + 2.

    A node splits the sample's points half way between the two middle projections on a random
    direction. Projections are in double precision and summed row by row, so that a vector's leaf
    does not depend on the batch it is in.
    """

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        inner = (1 << depth) - 1
        self.depth = depth
        axes = rng.standard_normal((trees, inner, sample.shape[1]))
        self.axes = axes / np.linalg.norm(axes, axis=2, keepdims=True)
        self.cuts = np.zeros((trees, inner))
        for tree in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                here = members.pop(node)
                along = (sample[here] * self.axes[tree, node]).sum(axis=1)
                if len(here) > 1:
                    s, half = np.sort(along), len(here) // 2
                    self.cuts[tree, node] = (s[half - 1] + s[half]) / 2
                right = along > self.cuts[tree, node]
                members[2 * node + 1], members[2 * node + 2] = here[~right], here[right]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        out = np.empty((len(x), len(self.axes)), np.int32)
        for tree, (axes, cuts) in enumerate(zip(self.axes, self.cuts)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + ((x * axes[node]).sum(axis=1) > cuts[node])
            out[:, tree] = node - len(cuts)
        return out

    def visited(self, x: np.ndarray, leaves: int) -> list[list[int]]:
        """For each vector the leaves to search, as tree * leaves per tree + leaf.

        One priority queue holds the open nodes of all trees. A node's priority is the largest
        distance to a split on the wrong side of which it lies; the closest is opened first.
        """
        trees, inner = self.cuts.shape
        flat = self.axes.reshape(trees * inner, self.axes.shape[2])
        found = []
        for vector in x:
            margins = ((flat * vector).sum(axis=1) - self.cuts.ravel()).tolist()
            queue = [(0.0, tree, 0) for tree in range(trees)]
            chosen = []
            while queue and len(chosen) < leaves:
                away, tree, node = heapq.heappop(queue)
                while node < inner:
                    margin = margins[tree * inner + node]
                    near, far = (2, 1) if margin > 0 else (1, 2)
                    heapq.heappush(queue, (max(away, abs(margin)), tree, 2 * node + far))
                    node = 2 * node + near
                chosen.append(tree * (inner + 1) + node - inner)
            found.append(chosen)
        return found


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id",
    vector_column: str = "embedding", trees: int = TREES, depth: int = DEPTH,
    sample: int = SAMPLE, visited: float = VISITED,
    vectors_per_block: int = VECTORS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product): the ``k`` best found per query.

    Directions are random; their cut points are medians over at most ``sample`` vectors (those
    with the smallest hash of the id). Every vector is in the index. Trees have 2 ** ``depth``
    leaves, or as many as get SMALLEST_LEAF vectors each. A query opens the share ``visited`` of
    the leaves of all trees together, and every vector in them is compared exactly, in double
    precision. The share of vectors compared, and so the recall, does not depend on how many
    there are; with vectors that have no clusters it takes half of them for a recall of 0.9. A
    query that finds fewer than ``k`` vectors in all its leaves is compared with all vectors, so
    that no result is short.

    Vectors and queries meet in blocks of bounded size, which change nothing in the result: leaves
    are found once, before rows are dealt. Equal vectors beyond the k + 1 with the smallest ids can
    be in no result and are left out before the shuffle that finds them ends. Vectors that are
    null, zero, of another length than most, or hold null or non-finite components take no part,
    nor do null ids. A query does not find its own row; other rows, also of its id, are
    candidates, and of a repeated row each counts. Repeated queries have one list, two vectors of
    one id a list each. Ties go to the smaller id. Empty tables give no rows.
    """
    index, asked = _valid(vectors, id_column, vector_column), _valid(
        queries, id_column, vector_column
    )
    common = index.groupBy(F.size("vector").alias("n")).count().orderBy(
        F.desc("count"), F.desc("n")
    ).first()
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], result)
    index, asked = (df.filter(F.size("vector") == common["n"]) for df in (index, asked))
    same = Window.partitionBy(F.xxhash64("vector"), "vector").orderBy("id")
    index = index.groupBy("id", "vector").agg(F.count("*").alias("copies")).withColumn(
        "copy", F.row_number().over(same)
    ).filter(F.col("copy") <= k + 1).drop("copy")
    asked = asked.distinct()
    drawn = index.orderBy(F.xxhash64("id"), "id", "vector").limit(sample).select(
        "vector"
    ).toArrow()["vector"]
    size = index.count()
    depth = min(depth, max(0, (size // SMALLEST_LEAF).bit_length() - 1))
    opened = math.ceil(visited * trees * 2**depth)
    forest = Forest(_matrix(drawn), trees, depth)
    shared = spark.sparkContext.broadcast((forest.axes, forest.cuts))
    v_blocks = max(1, -(-size // vectors_per_block))
    q_blocks = max(1, -(-asked.count() // queries_per_block))

    def grown() -> Forest:
        out = Forest.__new__(Forest)
        out.axes, out.cuts = shared.value
        out.depth = depth
        return out

    def place(batches):
        own = grown()
        for batch in batches:
            leaves = own.leaves(_matrix(batch.column("vector")))
            yield batch.append_column("leaves", pa.array([v.tobytes() for v in leaves], pa.binary()))

    def route(batches):
        own = grown()
        for batch in batches:
            chosen = own.visited(_matrix(batch.column("vector")), opened)
            yield batch.append_column(
                "leaves", pa.array([np.array(c, np.int32).tobytes() for c in chosen], pa.binary())
            )

    def search(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        ids, x = np.asarray(left.column("id")), _matrix(left.column("vector"))
        names, q = np.asarray(right.column("id")), _matrix(right.column("vector"))
        copies, out = np.asarray(left.column("copies")), []
        if len(ids) and len(names):
            per_tree = 1 << depth
            leaves = b"".join(left.column("leaves").to_pylist())
            code = np.frombuffer(leaves, np.int32).reshape(-1, trees).astype(np.int64)
            code = code + per_tree * np.arange(trees)
            row = np.argsort(code.ravel(), kind="stable") // trees
            ends = np.searchsorted(np.sort(code.ravel()), np.arange(trees * per_tree + 1))
            named = right.column("number").to_pylist()
            for name, vector, number, chosen in zip(
                names, q, named, right.column("leaves").to_pylist()
            ):
                left_over = copies - ((ids == name) & (x == vector).all(axis=1))
                marked = np.zeros(len(ids), bool)
                for leaf in np.frombuffer(chosen, np.int32).tolist():
                    marked[row[ends[leaf]:ends[leaf + 1]]] = True
                found = marked & (left_over > 0)
                others = ~marked & (left_over > 0)
                # What was not opened is needed only if the query is short, which all blocks say.
                short = left_over[found].sum() < k
                for at, is_open in ((found, True), *([(others, False)] if short else [])):
                    at = np.flatnonzero(at)
                    rough = x[at] @ vector
                    if len(at) > k:
                        least = np.partition(rough, -k)[-k]
                        at = at[rough >= least - 1e-9 * (1 + abs(least))]
                    exact = (x[at] * vector).sum(axis=1)
                    best = np.lexsort((ids[at], -exact))
                    best = np.repeat(best, np.minimum(left_over[at][best], k))[:k]
                    out.append((
                        np.full(len(best), name), np.full(len(best), number), ids[at][best],
                        exact[best], np.full(len(best), is_open),
                    ))
        parts = [np.concatenate(c) for c in zip(*out)] if out else [[], [], [], [], []]
        return pa.table({
            "query_id": pa.array(parts[0], pa.int64()), "number": pa.array(parts[1], pa.int64()),
            "vec_id": pa.array(parts[2], pa.int64()), "score": pa.array(parts[3], pa.float64()),
            "opened": pa.array(parts[4], pa.bool_()),
        })

    placed = index.mapInArrow(place, "id long, vector array<double>, copies long, leaves binary")
    routed = asked.mapInArrow(route, "id long, vector array<double>, leaves binary")
    spread_v = placed.select(
        "*", F.pmod(F.xxhash64("id"), F.lit(v_blocks)).alias("v"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"),
    )
    spread_q = routed.select(
        "*", F.xxhash64("vector").alias("number"),
        F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int").alias("q"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(v_blocks - 1).cast("long"))).alias("v"),
    )
    found = spread_v.groupBy("v", "q").cogroup(spread_q.groupBy("v", "q")).applyInArrow(
        search, "query_id long, number long, vec_id long, score double, opened boolean"
    )
    each = Window.partitionBy("query_id", "number")
    found = found.withColumn("enough", F.count_if("opened").over(each) >= k).filter(
        F.col("opened") | ~F.col("enough")
    )
    return found.withColumn(
        "rank", F.row_number().over(each.orderBy(F.desc("score"), "vec_id"))
    ).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _valid(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vector = F.col("vector")
    bad = F.exists(
        vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    )
    return take(df, id_column, vector_column).toDF("id", "vector").select(
        F.col("id").cast("long").alias("id"), vector.cast("array<double>").alias("vector")
    ).filter(
        F.col("id").isNotNull() & vector.isNotNull() & ~bad & F.exists(vector, lambda c: c != 0)
    )


def _matrix(column) -> np.ndarray:
    """A column of equally long lists as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))

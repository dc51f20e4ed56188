"""Near copies among vectors: a forest of random-projection trees whose splits overlap."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import take, written
from tidemark.llm.simhash_dedup import components

THRESHOLD = 0.93
TREES = 8
LEAF = 256
BLOCK = 512
SAMPLE = 16_384
SPILL = 0.3
FITTED = 8
LEVELS = 40
# How far single precision may be off in a cosine, and double precision.
ROUGH, FINE = 1e-4, 1e-9
PAIRS_AT_ONCE = 16_384


class Forest:
    """Trees with a random direction per level and a cut per node; node i splits into 2 i, 2 i + 1.

    Points nearer to a cut than ``margin`` go to both sides. The cut of a node is, of the places
    between its sample points in the middle half, the one with the fewest points near it for the
    size of the smaller side, so it goes between clusters where there are any. A node of which
    more than half is near every cut is not split. Below level FITTED, nodes have the cuts of their
    ancestor on that level, one per later direction.
    """

    def __init__(self, sample: np.ndarray, reach: float, trees: int, spill: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        axes = rng.standard_normal((trees, LEVELS, dim))
        self.axes = axes / np.linalg.norm(axes, axis=2, keepdims=True)
        self.margin = spill * reach / math.sqrt(dim)
        self.fitted = min(FITTED, max(0, (len(sample) // 64).bit_length() - 1))
        leaves = 1 << self.fitted
        self.cuts = np.full((trees, leaves), np.inf)
        self.deep = np.full((trees, leaves, LEVELS - self.fitted), np.inf)
        for tree in range(trees):
            along = sample @ self.axes[tree].T
            members = {1: np.arange(len(sample))}
            for node in range(1, leaves):
                here = members.pop(node)
                level = node.bit_length() - 1
                cut = self.cuts[tree, node] = self._cut(along[here, level])
                right = along[here, level] > cut
                members[2 * node], members[2 * node + 1] = here[~right], here[right]
            for node, here in members.items():
                self.deep[tree, node - leaves] = [
                    self._cut(along[here, level]) for level in range(self.fitted, LEVELS)
                ]

    def _cut(self, points: np.ndarray) -> float:
        s = np.sort(points)
        low, high = len(s) // 4, -(-3 * len(s) // 4)
        if high - low < 2:
            return np.inf
        cuts = (s[low:high - 1] + s[low + 1:high]) / 2
        near = np.searchsorted(s, cuts + self.margin) - np.searchsorted(s, cuts - self.margin)
        left = np.arange(low + 1, high)
        best = np.argmin((near + 1) / np.minimum(left, len(s) - left))
        return cuts[best] if 2 * near[best] <= len(s) else np.inf

    def leaves(self, x: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and leaf of every place of every row of x, at the depth that each row has.

        Leaves are numbered tree by tree. Rows of depth 0 are in the first tree alone.
        """
        axes = self.axes[:, :, np.arange(x.shape[1]) % self.axes.shape[2]]
        rows, leaves = [], []
        for tree in range(len(axes)):
            row = np.flatnonzero(depth > 0) if tree else np.arange(len(x))
            node = np.ones(len(row), np.int64)
            for level in range(int(depth.max(initial=0))):
                if level < self.fitted:
                    # Nodes of rows that stopped higher up are not looked at.
                    cut = self.cuts[tree, np.minimum(node, (2 << level) - 1)]
                else:
                    above = np.maximum(node >> (level - self.fitted), 1 << self.fitted)
                    cut = self.deep[tree, above - (1 << self.fitted), level - self.fitted]
                away = (x @ axes[tree, level])[row] - cut
                going = depth[row] > level
                left, right = ~going | (away <= self.margin), going & (away > -self.margin)
                node = np.concatenate([
                    np.where(going[left], 2 * node[left], node[left]), 2 * node[right] + 1
                ])
                row = np.concatenate([row[left], row[right]])
            rows.append(row)
            leaves.append(node + (tree << 48))
        return np.concatenate(rows), np.concatenate(leaves)


def near_copies(
    vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF,
    block: int = BLOCK, sample: int = SAMPLE, spill: float = SPILL, id_column: str = "vec_id",
    vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept.

    Rows with one label are linked if the cosine of their vectors, in double precision, is at
    least ``threshold``; n_links counts the others that a row is linked with, copies included.
    component_id is the smallest vec_id that links lead to, and kept says whether that is the
    row's own. Null labels, and vectors that are null, zero or hold null or non-finite components,
    link with nothing; nor do vectors of different lengths. Rows without an id count as links,
    but name no component: one of such rows alone has a null component_id, and all its rows are
    kept. Repeated rows are rows of their own. An empty table gives no rows.

    Equal vectors of a label are one class, so copies are never compared. Classes are routed
    down ``trees`` trees, as deep as brings their label's classes to about ``leaf`` a leaf. A pair
    at the threshold differs by some typical amount along a random direction: what lies within
    ``spill`` times that of a cut goes to both sides. Cuts come from at most ``sample`` vectors with
    the smallest hashes; every vector is routed. A leaf with more than ``block`` classes (near
    copies that no cut separates) is dealt into parts, and every two parts meet in a task of their
    own. A pair is counted in the first leaf it shares. A pair that no tree brings together is
    missed: the more trees and overlap, the fewer.
    """
    spark = vectors.sparkSession
    rows = _rows(vectors, id_column, vector_column, label_column)
    key = ["k1", "k2", "size", "label", "vector"]
    classes = written(
        rows.filter("valid").groupBy(*key).agg(
            F.min("id").alias("least"), F.count("*").alias("copies")
        ).withColumn("node", F.monotonically_increasing_id()), "classes",
    )
    drawn = classes.orderBy("k1", "k2").limit(sample).select("vector").toArrow()["vector"]
    drawn = [np.asarray(v.values, np.float64) for v in drawn]
    dim = max((len(v) for v in drawn), default=1)
    drawn = [np.pad(v, (0, dim - len(v))) / _norms(v[None])[0] for v in drawn]
    shared = spark.sparkContext.broadcast(Forest(
        np.array(drawn).reshape(-1, dim), math.sqrt(2 - 2 * threshold), trees, spill
    ))
    # A split leaves a little over half of a node on each side.
    levels = F.ceil(F.log(F.col("classes") / F.lit(float(leaf))) / F.lit(-math.log(0.55)))
    depth = F.least(F.greatest(levels, F.lit(0)), F.lit(LEVELS)).cast("int")
    depths = classes.groupBy("label", "size").agg(F.count("*").alias("classes")).select(
        "label", "size", depth.alias("depth")
    )

    def route(batches):
        forest = shared.value
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            for size in np.unique(sizes):
                of = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(of))
                x = _matrix(part.column("vector"))
                row, found = forest.leaves(
                    x / _norms(x)[:, None], np.asarray(part.column("depth"))
                )
                order = np.lexsort((found, row))
                row, found = row[order], found[order]
                ends = np.searchsorted(row, np.arange(len(x) + 1))
                own = [found[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                at = pa.array(row)
                for start in range(0, len(row), 8192):
                    part_at = at.slice(start, 8192)
                    out = part.drop_columns(["depth"]).take(part_at)
                    yield out.append_column("leaf", pa.array(found[start:start + 8192])) \
                        .append_column("leaves", pa.array(own, pa.binary()).take(part_at))

    routed = classes.join(depths, ["label", "size"]).select(
        "node", "label", "size", "copies", "vector", "depth"
    )
    kinds = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in routed.schema if f.name != "depth"
    )
    members = routed.mapInArrow(route, f"{kinds}, leaf long, leaves binary")
    large = members.groupBy("label", "size", "leaf").agg(
        F.ceil(F.count("*") / F.lit(block)).alias("parts")
    ).filter("parts > 1")
    part = F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1)))
    met = members.join(large, ["label", "size", "leaf"], "left").withColumn("part", part)
    met = met.withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))
    ).withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    found = written(
        met.drop("parts", "other").groupBy("label", "size", "leaf", "low", "high").applyInArrow(
            lambda table: _compare(table, threshold), "a long, b long, links long"
        ), "links",
    )
    links = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    nodes = classes.select("k1", "k2", "node", "least", "copies").join(
        links, F.col("node") == F.col("a"), "left"
    ).drop("a").join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    nodes = nodes.select(
        "k1", "k2", "least", F.coalesce("root", "node").alias("root"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    names = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(names, "root").select("k1", "k2", "n_links", "component_id")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    # Rows without a class match nothing, and are spread by their id.
    return rows.select(
        "id", F.when(F.col("valid"), F.col("k1")).otherwise(F.xxhash64("id")).alias("k1"),
        F.when(F.col("valid"), F.col("k2")).alias("k2"),
    ).join(named, ["k1", "k2"], "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )


def _rows(df: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """id, label, vector, size, valid, and two hashes that together name label and vector."""
    plain = take(df, id_column, vector_column, label_column).toDF("id", "vector", "label")
    if plain.schema["vector"].dataType.simpleString() not in ("array<float>", "array<double>"):
        plain = plain.withColumn("vector", F.col("vector").cast("array<double>"))
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    valid = F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists(
        "vector", lambda c: c != 0
    )
    return plain.select(
        F.col("id").cast("long").alias("id"), "label", "vector",
        F.size("vector").alias("size"), F.coalesce(valid, F.lit(False)).alias("valid"),
        F.xxhash64("label", "vector").alias("k1"),
        F.xxhash64(F.lit("second"), "vector", "label").alias("k2"),
    )


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows; scaled first, so that no square over- or underflows."""
    most = np.abs(x).max(axis=1, initial=0)
    most[most == 0] = 1
    return np.sqrt(((x / most[:, None]) ** 2).sum(axis=1)) * most


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """The linked pairs of two parts of a leaf: links gained per node, and connecting edges."""
    node, copies = np.asarray(table["node"]), np.asarray(table["copies"])
    x = _matrix(table["vector"])
    x = x / np.abs(x).max(axis=1, initial=0)[:, None]
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    part, low, high = (np.asarray(table[n]) for n in ("part", "low", "high"))
    own = np.flatnonzero(part == low)
    guests = own if low[0] == high[0] else np.flatnonzero(part == high)
    single = x.astype(np.float32)
    a, b = np.nonzero(single[own] @ single[guests].T >= threshold - ROUGH)
    a, b = own[a], guests[b]
    if low[0] == high[0]:
        a, b = a[a < b], b[a < b]
    leaf = table["leaf"][0].as_py()
    earlier = [
        (lambda v: v[v < leaf])(np.frombuffer(raw.as_buffer(), np.int64)) for raw in table["leaves"]
    ]
    width = max(map(len, earlier))
    before = np.full((len(node), width), -1)
    for i, v in enumerate(earlier):
        before[i, :len(v)] = v
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), PAIRS_AT_ONCE):
        i, j = a[at:at + PAIRS_AT_ONCE], b[at:at + PAIRS_AT_ONCE]
        keep[at:at + PAIRS_AT_ONCE] = (x[i] * x[j]).sum(axis=1) >= threshold
        theirs = before[j]
        for column in before[i].T:
            hit = (theirs == column[:, None]).any(axis=1) & (column >= 0)
            keep[at:at + PAIRS_AT_ONCE] &= ~hit
    a, b = a[keep], b[keep]
    gained = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
    near = np.zeros((len(node), len(node)), bool)
    near[a, b] = near[b, a] = True
    edges, seen = [], np.zeros(len(node), bool)
    for start in np.unique(a):
        frontier = np.array([start] if not seen[start] else [], np.int64)
        seen[frontier] = True
        while len(frontier):
            frontier = np.flatnonzero(near[frontier].any(axis=0) & ~seen)
            seen[frontier] = True
            edges += [(start, other) for other in frontier]
    linked = np.flatnonzero(gained)
    ends = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({
        "a": pa.array(np.concatenate([node[linked], node[ends[:, 0]]]), pa.int64()),
        "b": pa.concat_arrays([
            pa.nulls(len(linked), pa.int64()), pa.array(node[ends[:, 1]], pa.int64())
        ]),
        "links": pa.concat_arrays([
            pa.array(gained[linked].astype(np.int64)), pa.nulls(len(ends), pa.int64())
        ]),
    })

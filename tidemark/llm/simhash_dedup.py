"""SimHash fingerprints, links by Hamming distance found in BK-trees, and their components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashes, restored, split_words, texts, written

SEED = 42
SHARD = 2048
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BITS = _BITS.astype(np.int64)


def simhash(text: str | None, width: int = 3) -> int:
    """A bit is set if it is set in over half the shingle hashes; 0 without words."""
    words = [w for w in text.encode().lower().split()] if text else []
    if not words:
        return 0
    if len(words) < width:
        parts = [b" ".join(words)]
    else:
        parts = list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    octets = hashes(parts, SEED).view(np.uint8).reshape(-1, 8)
    ones = np.concatenate(
        [np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)]
    )
    packed = np.packbits(2 * ones > len(parts), bitorder="little")
    return int.from_bytes(packed.tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, carried columns and fp, the fingerprint as a signed long."""
    rows = texts(docs, *carry)

    def add(batches):
        for batch in batches:
            values = [simhash(t, width) for t in batch.column("text").to_pylist()]
            fps = pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())
            yield batch.append_column("fp", fps)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return restored(rows.mapInArrow(add, f"{kinds}, fp long"), carry)


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """Per row: doc_id, fingerprint (16 lower-case hex digits) and component_id.

    Fingerprints with at most ``radius`` differing bits are linked, and so are the documents
    that share one; component_id is the smallest doc_id that links lead to. A null or empty text
    has fingerprint zero and links like any other. Null doc_ids are kept and name no component,
    so a component of such rows alone has a null component_id. An empty table gives no rows.
    """
    fps = written(
        fingerprints(docs, width).select("doc_id", "fp"), "simhash"
    )
    return _labelled(fps, radius).select("doc_id", hexed("fp").alias("fingerprint"), "component_id")


def hexed(name: str):
    return F.lpad(F.lower(F.hex(name)), 16, "0")


def deduplicated(
    docs: DataFrame, width: int = 3, radius: int = 3, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (null last), then fingerprint.

    Of rows with one doc_id and fingerprint that differ, the one with the smallest hash of all
    columns (maps left out) stays.
    """
    rows = texts(docs, *carry)
    hashed = [F.col(f.name) for f in rows.schema if "map<" not in f.dataType.simpleString()]
    rows = rows.withColumn("row", F.xxhash64(*hashed))
    keyed = written(
        fingerprints(rows, width, ("row",)).select("doc_id", "row", "fp"), "simhash")
    # One row per fingerprint before the join: copies of a document do not meet in one task.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "row"))
    firsts = keyed.groupBy("fp").agg(first.alias("first"))
    chosen = firsts.join(_rooted(keyed, radius), "fp").groupBy("root").agg(
        F.min("first").alias("best")).select(
        F.col("best.doc_id").alias("chosen_id"), F.col("best.row").alias("chosen_row"))
    kept = rows.join(
        chosen, F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("row") == F.col("chosen_row")),
        "left_semi",
    )
    return restored(kept.dropDuplicates(["doc_id", "row"]).drop("row"), carry)


def _labelled(fps: DataFrame, radius: int) -> DataFrame:
    """doc_id, fp and component_id."""
    rooted = _rooted(fps, radius)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(fps: DataFrame, radius: int) -> DataFrame:
    """Per fingerprint: fp, least (its smallest doc_id) and root (a fingerprint of the component)."""
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(written(links(nodes.select("fp"), radius), "links"))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def links(nodes: DataFrame, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, enough to connect all that differ in few bits.

    The 64 bits are cut into radius + 2 blocks. Two fingerprints within the radius agree on at
    least two blocks, so they share one of the keys made of two blocks each (10 keys of 25 bits
    at radius 3). The fingerprints of a key are cut into shards of about ``shard``; each shard
    is a BK-tree, searched by its own fingerprints and by those of later shards, so that a key
    shared by very many is many tasks. A pair already connected through the tree is left out.
    """
    cuts = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    blocks = list(zip(cuts, cuts[1:]))

    def bits(low, high):
        return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))

    keys = [
        F.shiftleft(bits(*blocks[a]), blocks[b][1] - blocks[b][0]).bitwiseOR(bits(*blocks[b]))
        + F.lit(i << 48)
        for i, (a, b) in enumerate(combinations(range(len(blocks)), 2))
    ]
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    shared = keyed.groupBy("key").count().filter("count > 1")
    parts = F.ceil(F.col("count") / F.lit(shard))
    dealt = (
        keyed.join(shared, "key")
        .withColumn("part", F.pmod(F.xxhash64("fp"), parts))
        .withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part"))))
        .select("key", "tree", (F.col("part") != F.col("tree")).alias("guest"), "fp")
    )
    return (
        dealt.repartition("key", "tree")
        .sortWithinPartitions("key", "tree", "guest", "fp")
        .mapInArrow(lambda batches: _search(batches, radius), "a long, b long")
        .distinct()
    )


class BKTree:
    """Fingerprints; the children of a node are keyed by their Hamming distance to it."""

    def __init__(self):
        self.root = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            apart = (node[0] ^ value).bit_count()
            if apart == 0:
                return
            child = node[1].get(apart)
            if child is None:
                node[1][apart] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int):
        stack = [self.root] if self.root else []
        while stack:
            node, children = stack.pop()
            apart = (node ^ value).bit_count()
            if apart <= radius:
                yield node
            for edge in range(apart - radius, apart + radius + 1):
                if edge in children:
                    stack.append(children[edge])


def _search(batches, radius: int):
    at, tree, parent = None, None, {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        found = []
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for key, part, guest, fp in zip(*columns):
            if (key, part) != at:
                at, tree, parent = (key, part), BKTree(), {}
            value = fp & 0xFFFFFFFFFFFFFFFF
            if guest:
                found += {root(x): (fp, x) for x in tree.within(value, radius)}.values()
                continue
            parent[value] = value
            for x in tree.within(value, radius):
                if root(x) != root(value):
                    parent[root(x)] = root(value)
                    found.append((fp, x))
            tree.add(value)
        if found:
            a, b = zip(*found)
            b = pa.array(np.array(b, np.uint64).view(np.int64))
            yield pa.record_batch([pa.array(a, pa.int64()), b], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node that has an edge.

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    smallest one, then its smaller ones. Each step shuffles edges only and combines before the
    shuffle; a round's edges are written to the shared folder.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a != b").distinct(), "edges",
    )
    seen = None
    while True:
        sign = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if sign == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b"), F.col("b"))
            ).distinct()
        seen = sign
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).union(least)
        now = written(small.distinct(), "edges")

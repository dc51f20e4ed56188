"""Tries of conversations that share their first turns, in balanced parentheses per shard."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import take, written

DIGEST = 16
LEVEL = 64
SHARD_NODES = 1 << 18
ROWS_OUT = 16_384


class Parentheses:
    """A tree as balanced parentheses, one pair per node in preorder.

    The excess of a place is the number of pairs open after it. Blocks of LEVEL places keep their
    least excess, and so do pairs of blocks, pairs of those, and so on (a range min-max tree of
    which closing needs the minima only).
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int64)
        self.opens = np.flatnonzero(bits)
        self.rank = np.cumsum(bits, dtype=np.int64)
        n = -(-len(bits) // LEVEL)
        self.padded = np.full(n * LEVEL, np.iinfo(np.int64).max)
        self.padded[:len(bits)] = self.excess
        self.least = [self.padded.reshape(n, LEVEL).min(axis=1, initial=np.iinfo(np.int64).max)]
        while len(self.least[-1]) > 1:
            row = self.least[-1]
            row = np.append(row, np.iinfo(np.int64).max) if len(row) % 2 else row
            self.least.append(row.reshape(-1, 2).min(axis=1))

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The place of the parenthesis that closes each open one."""
        out = np.empty(len(opens), np.int64)
        for start in range(0, len(opens), 4096):
            at = opens[start:start + 4096]
            goal = self.excess[at] - 1
            block = at // LEVEL
            found = self._first(block, goal, at + 1)
            # Not in the own block: up, as long as no block to the right is low enough, then down.
            block, level, open_still = block + 1, 0, found < 0
            missing = np.flatnonzero(open_still)
            node, depth = block[missing], np.zeros(len(missing), np.int64)
            going = np.ones(len(missing), bool)
            while going.any():
                row = self.least[level]
                low = going & (row[np.minimum(node, len(row) - 1)] <= goal[missing])
                depth[low], going[low] = level, False
                node = np.where(going, (node + 1) // 2, node)
                level += 1
            for level in range(level, 0, -1):
                down = depth == level
                left = 2 * node[down]
                hit = self.least[level - 1][left] <= goal[missing][down]
                node[down] = np.where(hit, left, left + 1)
                depth[down] = level - 1
            found[missing] = self._first(node, goal[missing], node * LEVEL)
            out[start:start + 4096] = found
        return out

    def _first(self, block: np.ndarray, goal: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place of each block, from ``least`` on, whose excess is the goal; else -1."""
        places = block[:, None] * LEVEL + np.arange(LEVEL)
        hit = (self.padded[places] == goal[:, None]) & (places >= least[:, None])
        return np.where(hit.any(axis=1), places[:, 0] + hit.argmax(axis=1), -1)

    def leaf_pairs(self) -> np.ndarray:
        """Up to each place, how many pairs with nothing between them are opened."""
        leaf = self.bits.astype(bool)
        leaf[:-1] &= self.bits[1:] == 0
        return np.cumsum(leaf, dtype=np.int64)


def rebuilt(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """conv_id, and its rebuilt turns as two binaries: key (a digest a turn) and chars (int32).

    A conversation c is the first h turns of conversation c - c % ``group``, then its own turns
    after its first h; h = crc32(c) % ``most``. Turns are ordered by number (null first), then
    role and text. Texts stay where they are read: what is gathered is DIGEST + 4 bytes a turn.
    """
    rows = take(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).filter("c IS NOT NULL")
    # The length keeps role and text apart.
    said = F.concat_ws(":", F.length("role"), "role", "text")
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    turns = rows.select(
        "c", "turn", "role", F.unhex(F.md5(said)).alias("key"),
        F.length("text").cast("int").alias("chars"),
    ).withColumn("at", F.row_number().over(order))
    turns = written(turns.select("c", "at", "key", "chars"), "turns")
    shared = F.pmod(F.crc32(F.col("c").cast("string")), F.lit(most))
    convs = turns.select("c").distinct().withColumn("h", shared)
    own = turns.filter(F.col("at") > shared)
    heads = turns.filter(F.col("at") < most).withColumnRenamed("c", "donor")
    given = convs.withColumn("donor", F.col("c") - F.col("c") % group).join(heads, "donor").filter(
        "at <= h"
    ).select("c", "at", "key", "chars")
    parts = own.unionByName(given).unionByName(convs.select(
        "c", F.lit(0).alias("at"), F.lit(b"").alias("key"), F.lit(None).cast("int").alias("chars")
    ))
    said = F.array_sort(F.collect_list(F.struct("at", "key", "chars")))
    packed = parts.groupBy("c").agg(said.alias("said"))
    return packed.select(
        F.col("c").alias("conv_id"),
        F.array_join(F.transform("said", lambda s: F.hex(s["key"])), "").alias("key"),
        F.transform(F.slice("said", 2, F.size("said")), lambda s: s["chars"]).alias("chars"),
    ).withColumn("key", F.unhex("key"))


def _digest(key: bytes, depth: int) -> bytes:
    return hashlib.md5(key[:depth * DIGEST]).digest()


def _ids(values) -> str:
    return ",".join(map(str, values))


def _shard(name: int, convs: list[int], keys: list[bytes], chars: list[list[int]]):
    """The trie of sorted sequences: final rows of its inner nodes, and its first and last path.

    The nodes of the first and the last path may be in the neighbouring shards too, so their rows
    hold what this shard adds to them.
    """
    nodes, opened, closed = 1, [], [0]
    first, last, parent, at_depth, size = [0], [0], [-1], [0], [0]
    tip, path, before = [], [0], b""
    for i, (key, lens) in enumerate(zip(keys, chars)):
        depth, most = len(key) // DIGEST, min(len(key), len(before)) // DIGEST
        low, high = 0, most
        while low < high:  # how many turns it shares with the one before
            mid = (low + high + 1) // 2
            same = key[:mid * DIGEST] == before[:mid * DIGEST]
            low, high = (mid, high) if same else (low, mid - 1)
        if i:
            closed.append(len(before) // DIGEST - low)
        opened.append(depth - low)
        del path[low + 1:]
        for d in range(low, depth):
            parent.append(path[-1])
            at_depth.append(d + 1)
            size.append(lens[d])
            first.append(i)
            path.append(nodes)
            nodes += 1
        tip.append(path[-1])
        before = key
    counts = np.empty(2 * len(keys), np.int64)
    counts[0::2], counts[1::2] = opened, [*closed[1:], len(before) // DIGEST]
    counts[0] += 1
    counts[-1] += 1
    bits = np.repeat(np.tile(np.array([1, 0], np.uint8), len(keys)), counts)
    tree = Parentheses(bits)
    ends = tree.findclose(tree.opens)
    tip, parent, at_depth, size = (np.array(v) for v in (tip, parent, at_depth, size))
    own = np.bincount(tip, minlength=nodes)
    upto = tree.rank[ends]  # preorder numbers below this are in the subtree or before it
    numbers = np.arange(nodes)

    def below(values):
        total = np.concatenate([[0], np.cumsum(values)])
        return total[upto] - total[numbers]

    members = below(own)
    # Sequences come in preorder, so a subtree's are neighbours: as many, from the first on.
    start = np.concatenate([[0], np.cumsum(own)])[numbers]
    table = [np.array(convs)]
    while 2 << (len(table) - 1) <= len(convs):
        step = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    power = np.frexp(members)[1] - 1
    least = np.empty(nodes, np.int64)
    for p in np.unique(power):
        of = power == p
        least[of] = np.minimum(table[p][start[of]], table[p][start[of] + members[of] - (1 << p)])

    def path_of(key, node):
        out = []
        while node >= 0:
            out.append(node)
            node = parent[node]
        return [(n, _digest(key, d)) for d, n in enumerate(reversed(out))]

    sides = [path_of(keys[0], tip[0]), path_of(keys[-1], tip[-1])]
    spine = dict(sides[0] + sides[1])
    inner = np.ones(nodes, bool)
    inner[list(spine)] = False
    children = np.bincount(parent[1:][inner[1:]], minlength=nodes)
    pairs = np.concatenate([[0], tree.leaf_pairs()])
    leaves = pairs[ends + 1] - pairs[tree.opens]
    leaf = bits[np.minimum(tree.opens + 1, len(bits) - 1)] == 0
    leaves -= below(leaf & ~inner)
    saved = below(np.where(inner, (members - 1) * size, 0))
    ends_at = np.concatenate([[0], np.cumsum(own)])
    empty = hashlib.sha256(b"").hexdigest()
    by_tip = {}
    for node in np.flatnonzero(own):
        # Equal sequences are neighbours, smaller ids first, and come before longer ones.
        at = ends_at[node]
        by_tip[int(node)] = _ids(convs[at:at + own[node]])
    columns = [least, at_depth, members, children, leaves, saved]

    def row(kind, node, side, parts):
        up = int(parent[node])
        ids = by_tip.get(node, "")
        given = [int(c[node]) if parts or c is at_depth or c is least else 0 for c in columns]
        return (
            kind, name, side, spine.get(node), spine.get(up),
            None if up in spine or up < 0 else int(least[up]), *given, int(size[node]),
            ids if kind and parts else "",
            None if kind else hashlib.sha256(ids.encode()).hexdigest() if ids else empty,
            int(convs[ends_at[node]]) if kind and ids else None,
        )

    for node in np.flatnonzero(inner):
        yield row(0, int(node), None, True)
    once = set()
    for side, nodes_of in enumerate(sides):
        for node, _ in nodes_of:
            yield row(1, int(node), side, node not in once)
            once.add(node)


_KINDS = (
    "spine int, shard long, side int, node binary, parent binary, parent_conv_id long, "
    "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "chars long, ids string, ends_sha256 string, first_end long"
)
_ARROW = [
    (n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[k])
    for n, k in (c.split() for c in _KINDS.split(", "))
]


def _batch(rows):
    return pa.record_batch(
        [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), _ARROW)],
        names=[n for n, _ in _ARROW],
    )


def shards(sequences: DataFrame, most_nodes: int = SHARD_NODES) -> DataFrame:
    """The tries of neighbouring sequences, one per task or per about ``most_nodes`` turns."""

    def build(batches):
        base, n = TaskContext.get().partitionId() << 32, 0
        held, nodes, rows = ([], [], []), 0, []

        def out():
            nonlocal n, held, nodes
            yield from _shard(base + n, *held)
            held, nodes, n = ([], [], []), 0, n + 1

        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "chars"))):
                for column, value in zip(held, values):
                    column.append(value)
                nodes += len(values[2]) + 1
                if nodes >= most_nodes:
                    for row in out():
                        rows.append(row)
                        if len(rows) == ROWS_OUT:
                            yield _batch(rows)
                            rows = []
        if held[0]:
            for row in out():
                rows.append(row)
                if len(rows) == ROWS_OUT:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    return sequences.repartitionByRange("key", "conv_id").sortWithinPartitions(
        "key", "conv_id"
    ).select("conv_id", "key", "chars").mapInArrow(build, _KINDS)


def prefix_trie(
    conversations: DataFrame, group: int = 100, most: int = 6, most_nodes: int = SHARD_NODES,
) -> DataFrame:
    """Per distinct sequence of first turns: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.

    Conversations are rebuilt by ``rebuilt``, then sorted, so that those with a common beginning are
    neighbours, whole copies included; a run of neighbours is a shard, however many share a turn.
    Only the first and the last path of a shard can go on in others. Their nodes' counts are added
    up by the digest of the path, and what lies below them on other shards' paths by sums along
    each path, from its end, of the nodes that no earlier path has.

    Rows without a conv_id are in no conversation. Repeated rows and equal turn numbers are turns
    of their own; a null role or text is empty. A conversation without rebuilt turns ends at the
    root. An empty table gives no rows.
    """
    built = written(shards(rebuilt(conversations, group, most), most_nodes), "shards")
    inner, paths = built.filter("spine = 0"), built.filter("spine = 1")
    merged = paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("parent").alias("parent"), F.max("chars").alias("chars"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.min(F.struct("shard", "side")).alias("owner"),
    )
    kids = merged.filter("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("kids"))
    merged = written(merged.join(kids.withColumnRenamed("parent", "node"), "node", "left").select(
        "node", "conv_id", "depth", "n_convs", "n_leaves", "saved_tokens", "owner",
        (F.col("n_children") + F.coalesce("kids", F.lit(0))).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"),
    ), "spines")
    known = paths.select("node", "shard", "side", "parent").join(
        merged.select("node", "conv_id", "depth", "owner", "own_saved", "n_children"), "node"
    )
    owned = F.col("owner") == F.struct("shard", "side")
    up = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))
    down = Window.partitionBy("shard", "side").orderBy("depth")
    known = written(known.select(
        "node", "shard", "side", "conv_id",
        F.lag("conv_id").over(down).alias("parent_conv_id"),
        F.sum(F.when(owned, F.col("own_saved")).otherwise(0)).over(up).alias("saved"),
        F.sum(F.when(owned & (F.col("n_children") == 0), 1).otherwise(0)).over(up).alias("leaves"),
    ), "paths")
    sums = known.groupBy("node").agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"),
        F.max("parent_conv_id").alias("parent_conv_id"),
    )
    ends = paths.filter("ids != ''").select("node", "first_end", "ids").repartition(
        "node"
    ).sortWithinPartitions("node", "first_end").mapInArrow(
        _hash_ends, "node binary, ends_sha256 string"
    )
    names = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    )
    top = merged.join(sums, "node").join(ends, "node", "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.col("leaves"),
        "saved_tokens": F.col("saved_tokens") + F.col("saved"),
        "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)),
    }).select(*names)
    # A shard's inner nodes below its own paths: met by shard, so the children of a node with very
    # many are in as many groups as shards.
    above = known.groupBy("shard", "node").agg(F.first("conv_id").alias("up")).withColumnRenamed(
        "node", "parent"
    )
    low = inner.join(above, ["shard", "parent"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "up")
    ).select(*names)
    return top.unionByName(low)


def _hash_ends(batches):
    at, digest = None, None
    for batch in batches:
        done = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != at:
                if at is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if done:
            yield _ends(done)
    if at is not None:
        yield _ends([(at, digest.hexdigest())])


def _ends(done):
    nodes, digests = zip(*done)
    return pa.record_batch(
        [pa.array(nodes, pa.binary()), pa.array(digests, pa.string())],
        names=["node", "ends_sha256"],
    )

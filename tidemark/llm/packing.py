"""Packing of token sequences: bounded-space best-fit with open bins in a bitset by free space."""

from __future__ import annotations

import base64
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts

CAPACITY = 1024
OPEN_BINS = 4096
ROWS_PER_SHARD = 8192
MOST_SHARDS = 20_000


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the public tokenizers' files are, if they are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(data: bytes, kind: str):
    """A function from text to ids: of a rank file (tiktoken) or a tokenizers file (json).

    Strings of special tokens in a text are ordinary text.
    """
    if kind == ".json":
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(data.decode())
        tokenizer.encode_special_tokens = True
        return lambda text: np.array(
            tokenizer.encode(text, add_special_tokens=False).ids, np.uint32
        )
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    bpe = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: bpe.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)


def pieces(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = 2,
) -> DataFrame:
    """doc_id, piece, start, length, ids: each text's ids and the end id, cut to capacity.

    Only longer ones are cut; all pieces but the first are then full. A null text is the end id.
    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers, one after the other.
    """
    path = Path(tokenizer or vocabulary())
    data = docs.sparkSession.sparkContext.broadcast(path.read_bytes())
    kind = path.suffix

    def cut(batches):
        encode = encoder(data.value, kind)
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(text), np.uint32(end)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for i, (a, b) in enumerate(zip(edges, edges[1:])):
                    values = (doc, i, a, b - a, ids[a:b].tobytes())
                    for column, value in zip(out, values):
                        column.append(value)
            yield pa.record_batch(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in out[2:4]], pa.array(out[4], pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return texts(docs).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary"
    )


class OpenBins:
    """At most ``most`` open bins; bit f of a set is on if a bin with free space f is open."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free, self.bins, self.open, self.made = 0, [[] for _ in range(capacity + 1)], 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin of an item and its place there: the fullest that fits, else a new one."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            name = self._pop(space)
        else:
            if self.open == self.most:
                self._pop((self.free & -self.free).bit_length() - 1)
            space, name = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            self.bins[left].append(name)
            self.free |= 1 << left
            self.open += 1
        return name, self.capacity - space

    def _pop(self, space: int) -> int:
        name = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return name


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = 2,
    open_bins: int = OPEN_BINS, rows_per_shard: int = ROWS_PER_SHARD,
) -> DataFrame:
    """The pieces of ``pieces`` with sequence_id and offset: gapless, at most capacity each.

    Their ids, in order of offset, are the sequences: ready to train on, with no text encoded again.
    Pieces are dealt into shards by hash, one per ``rows_per_shard`` documents up to MOST_SHARDS
    (beyond, shards grow and nothing else changes). A shard packs as a stream and holds
    ``open_bins`` bins; where more would be open, the fullest closes. The stream comes in blocks of
    about ``rows_per_shard`` documents, longest piece first in each, so a block's short pieces
    fill what its long ones leave. A block by itself opens fewer bins than OPEN_BINS.

    A shard's order depends on the rows alone, so a repeated task gives the same sequences. A
    null text is a piece of one id; repeated rows are pieces of their own; an empty table gives
    no rows.
    """
    rows = docs.count()
    shards = min(MOST_SHARDS, max(1, -(-rows // rows_per_shard)))
    blocks = max(1, -(-rows // (shards * rows_per_shard)))
    digest = F.xxhash64("ids")
    order = F.pmod(F.xxhash64("piece", "doc_id", digest), F.lit(blocks))

    def place(batches):
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            names, offsets = zip(*placed) if placed else ((), ())
            yield batch.append_column(
                "sequence_id", pa.array([base + n for n in names], pa.int64())
            ).append_column("offset", pa.array(offsets, pa.int64()))

    return (
        pieces(docs, tokenizer, capacity, end)
        .repartition(shards, "doc_id", "piece", digest)
        .sortWithinPartitions(order, F.desc("length"), "doc_id", "piece", digest)
        .mapInArrow(
            place,
            "doc_id long, piece int, start long, length long, ids binary, "
            "sequence_id long, offset long",
        )
    )

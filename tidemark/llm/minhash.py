"""Document fingerprints: one-permutation MinHash, optimally densified, low-order bits packed."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hashes, mixed, restored, rolling, split_words, texts, written

BINS = 256
BITS = 4
SHINGLE = 5


class Fingerprinter:
    """Fingerprints of ``bins`` (a power of two) times ``bits`` (a divisor of 8) bits, as hex.

    The leading bits of a shingle's hash name its bin, and each bin keeps its smallest hash, so
    a text is hashed once. An empty bin asks other bins, in an order that depends on the bin
    alone, and takes the value of the first that is not empty. Each value is scrambled with its
    bin, so that bins with one value differ by chance alone, and its lowest bits are stored. A
    text of fewer words than a shingle has one shingle, all its words.
    """

    def __init__(self, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE):
        if bins & (bins - 1) or not 2 <= bins <= 4096 or bits not in (1, 2, 4, 8):
            raise ValueError(f"bins must be a power of two, bits 1, 2, 4 or 8: {bins}, {bits}")
        self.bins, self.bits, self.shingle = bins, bits, shingle
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.starts = np.arange(bins, dtype=np.uint64) << self.shift
        self.salt = mixed(np.arange(1, bins + 1, dtype=np.uint64))
        self.asked = np.empty((0, bins), np.int64)

    def values(self, text: str | None) -> np.ndarray:
        words = split_words(text)
        if words:
            found = np.sort(rolling(hashes(words), min(self.shingle, len(words))))
        else:
            found = mixed(np.array([1], np.uint64))
        first = np.searchsorted(found, self.starts)
        full = np.diff(np.r_[first, len(found)]) > 0
        source = np.where(full, np.arange(self.bins), -1)
        empty, tries = np.flatnonzero(~full), 0
        while len(empty):
            asked = self._order(tries)[:, empty]
            hit = full[asked]
            done = hit.any(axis=0)
            source[empty[done]] = asked[hit.argmax(axis=0), np.arange(len(empty))][done]
            empty, tries = empty[~done], tries + 1
        kept = mixed(found[first[source]] ^ self.salt)
        return (kept & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def _order(self, tries: int, at_once: int = 64) -> np.ndarray:
        """The bins that each bin asks, a block of tries at a time."""
        while len(self.asked) <= tries * at_once:
            n = len(self.asked)
            seeds = np.arange(n * self.bins, (n + at_once) * self.bins, dtype=np.uint64)
            more = mixed(seeds + np.uint64(0x5851F42D4C957F2D)) >> self.shift
            self.asked = np.r_[self.asked, more.astype(np.int64).reshape(at_once, self.bins)]
        return self.asked[tries * at_once:(tries + 1) * at_once]

    def pack(self, values: np.ndarray) -> str:
        wide = np.unpackbits(values[:, None], axis=1)[:, 8 - self.bits:]
        return np.packbits(wide.ravel()).tobytes().hex()

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """The estimated Jaccard similarity: bins that agree, less those that agree by chance.

        Values kept to few bits agree by chance with probability 2 ** -bits.
        """
        chance = 2.0 ** -self.bits
        return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def fingerprints(
    docs: DataFrame, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, carried columns, n_chars (code points) and fingerprint.

    Equal texts have equal fingerprints. A null text counts as empty; empty texts equal each
    other and nothing else, save by chance. An empty table gives no rows.
    """
    rows = texts(docs, *carry)

    def add(batches):
        maker = Fingerprinter(bins, bits, shingle)
        for batch in batches:
            column = batch.column("text").to_pylist()
            marks = [maker.pack(maker.values(t)) for t in column]
            yield batch.drop_columns(["text"]).append_column(
                "n_chars", pa.array([len(t) for t in column], pa.int64())
            ).append_column("fingerprint", pa.array(marks, pa.string()))

    kinds = "".join(
        f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text"
    )
    return restored(rows.mapInArrow(add, f"{kinds}n_chars long, fingerprint string"), carry)


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def against_next(
    docs: DataFrame, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE,
) -> DataFrame:
    """Fingerprints of each text, compared with an edited text and with the next document's.

    Documents are in descending order of doc_id (null last; equal ids by a hash of the text),
    and the first follows the last. The edited text is the text with its last half, rounded
    down, replaced by as many code points from the start of the next one, or all it has. Per row:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    next of a single document is itself. A null text counts as empty; no rows give no rows.

    Texts are shuffled once, into sorted ranges; a task holds a batch and one row more. The last
    row of a range waits for the first one of the next: those two rows of each range are all
    that a second, small step joins.
    """
    rows = texts(docs).withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.desc("h")]

    def compare(maker, one, other):
        doc, text, values, _ = one
        half = len(text) // 2
        edited = text[:len(text) - half] + other[1][:half]
        changed = maker.values(edited)
        return (
            doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), maker.pack(values),
            maker.pack(changed), maker.likeness(values, changed),
            maker.likeness(values, other[2]),
        )

    def walk(batches):
        maker, part = Fingerprinter(bins, bits, shingle), TaskContext.get().partitionId()
        first = last = None
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now = (doc, text, maker.values(text), part)
                if last is None:
                    first = now
                else:
                    out.append((*compare(maker, last, now), None, None, None))
                last = now
            yield _batch(out)
        if last is not None:
            blank = (None,) * 6
            yield _batch([(last[0], *blank, part, last[1], first[1])])

    def finish(batches):
        maker = Fingerprinter(bins, bits, shingle)
        for batch in batches:
            out = []
            for doc, text, other in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                one = (doc, text, maker.values(text), 0)
                out.append(compare(maker, one, (None, other, maker.values(other), 0)))
            yield _batch([(*row, None, None, None) for row in out]).select(range(7))

    walked = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
        .mapInArrow(walk, f"{_RESULT}, part int, last string, first string"), "minhash"
    )
    ends = walked.filter("part IS NOT NULL")
    ring = Window.orderBy("part")
    following = ends.select(
        F.col("part"), F.coalesce(F.lead("part").over(ring), F.first("part").over(ring)).alias("to")
    )
    firsts = ends.select(F.col("part").alias("to"), F.col("first").alias("next_text"))
    open_rows = (
        ends.select("part", "doc_id", "last").join(following, "part").join(firsts, "to")
        .select("doc_id", F.col("last").alias("text"), "next_text")
    )
    done = walked.filter("part IS NULL").drop("part", "last", "first")
    return done.unionByName(open_rows.mapInArrow(finish, _RESULT))


def _batch(rows) -> pa.RecordBatch:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next", "part", "last", "first"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(),
             pa.string(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.record_batch(
        [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names
    )

"""Removal of word windows that an earlier document already holds (Rabin-Karp hashes)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NO_ID, binary, hashes, restored, rolling, split_words, texts

BATCH_CHARS = 8 << 20
BUCKET_WINDOWS = 1 << 21
CHARS_PER_WORD = 6
MOST_BITS = 20


def substring_dedup(
    docs: DataFrame, window: int = 13, carry: tuple[str, ...] = (), rejoin: bool = True,
    batch_chars: int = BATCH_CHARS, bucket_windows: int = BUCKET_WINDOWS,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """Per row: doc_id, carried columns, n_words, n_removed, removed and kept.

    ``removed`` lists the maximal intervals (start and end word, end excluded) of words covered
    by a window that also starts in a document with a smaller doc_id; ``kept`` is the other
    words joined by one space (without ``rejoin``, a text that loses no word stays as it is).
    Windows are judged on the input.

    Documents are dealt into batches of about ``batch_chars`` characters. Within a batch, a
    window's smallest doc_id is known at once, so a batch sends each window once, however many
    documents hold it: a passage in a third of all documents is a row per batch. Windows meet in
    buckets by the leading bits of their hash; a bucket answers a batch with the windows that a
    smaller doc_id of another batch holds. Texts are shuffled once and hashes once. There are up to
    2 ** ``most_bits`` buckets of about ``bucket_windows`` windows; beyond, a bucket holds more, and
    is sorted in passes of about that many by the bits that follow.

    Hashes have 64 bits: of n windows, about n * n / 2**65 pairs are taken for equal wrongly.
    A null text has no words. A null doc_id counts as the largest. Rows that repeat a doc_id do
    not remove each other's words. An empty table gives no rows. Other columns are ignored.
    """
    rows = texts(docs, *carry)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    batches = max(1, -(-chars // batch_chars))
    bits = min(most_bits, max(0, (chars // CHARS_PER_WORD // bucket_windows).bit_length()))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))

    def scan(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, found = _windows(table, window)
        h, doc = _flat(ids, found)
        order, first = _groups(h, doc)
        chosen = np.sort(order[first])
        h, doc = h[chosen], doc[chosen]
        bucket = h >> np.uint64(64 - bits) if bits else np.zeros(len(h), np.uint64)
        by = np.argsort(bucket, kind="stable")
        h, doc, bucket = h[by], doc[by], bucket[by]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        ends = [0, *cuts.tolist(), len(h)] if len(h) else [0]
        parts = [slice(a, b) for a, b in zip(ends, ends[1:])]
        runs = [_runs(doc[p]) for p in parts]
        return pa.table({
            "bucket": pa.array([int(bucket[p.start]) for p in parts], pa.int64()),
            "batch": pa.array([key[0].as_py()] * len(parts), pa.int64()),
            "ids": binary(r[0] for r in runs),
            "counts": binary(r[1].astype(np.uint32) for r in runs),
            "hashes": binary(h[p] for p in parts),
        })

    def meet(table: pa.Table) -> pa.Table:
        hashed, ids, counts = (
            [np.frombuffer(b.as_buffer(), kind) for b in table.column(name)]
            for name, kind in (("hashes", np.uint64), ("ids", np.int64), ("counts", np.uint32)))
        names = table.column("batch").to_numpy()
        more = max(0, -(-sum(map(len, hashed)) // (2 * bucket_windows)) - 1).bit_length()
        batches, known = [], []
        for turn in range(1 << more):
            picks = [_turn(h, bits, more) == turn if more else slice(None) for h in hashed]
            h = np.concatenate([h[p] for h, p in zip(hashed, picks)])
            doc = np.concatenate([np.repeat(i, c)[p] for i, c, p in zip(ids, counts, picks)])
            sizes = [len(h[p]) for h, p in zip(hashed, picks)]
            batch, late = _later(h, doc, np.repeat(names, sizes))
            found, starts = np.unique(batch, return_index=True)
            batches.append(found)
            known += np.split(late, starts[1:]) if len(found) else []
        return pa.table({
            "batch": pa.array(np.concatenate(batches), pa.int64()), "known": binary(known),
        })

    def cut(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        ids, found = _windows(left, window)
        h, doc = _flat(ids, found)
        known = [np.frombuffer(b, np.uint64) for b in right.column("known").to_pylist()]
        gone = np.isin(h, np.concatenate(known)) if known else np.zeros(len(h), bool)
        order, first = _groups(h, doc)
        if len(h):
            least = doc[order][np.flatnonzero(first)][np.cumsum(first) - 1]
            gone[order] |= doc[order] > least
        results, at = {}, 0
        for row, windows in found:
            results[row] = gone[at:at + len(windows)]
            at += len(windows)
        n_words, n_removed, spans, kept = [], [], [], []
        for row, text in enumerate(left.column("text").to_pylist()):
            words = split_words(text)
            starts = np.flatnonzero(results[row])
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + window, -1)
            covered = np.cumsum(cover[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.r_[False, covered, False]))
            n_words.append(len(words))
            n_removed.append(int(covered.sum()))
            spans.append([
                {"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])
            ])
            if len(starts):
                words = [w for w, c in zip(words, covered.tolist()) if not c]
            whole = len(starts) == 0 and not rejoin
            kept.append(text if whole else b" ".join(words).decode())
        out = left.drop_columns(["text", "batch"])
        for name, values, kind in (
            ("n_words", n_words, pa.int64()), ("n_removed", n_removed, pa.int64()),
            ("removed", spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("kept", kept, pa.string()),
        ):
            out = out.append_column(name, pa.array(values, kind))
        return out

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    carried = "".join(f", k{i} {kinds[f'k{i}']}" for i in range(len(carry)))
    sent = dealt.groupBy("batch").applyInArrow(
        scan, "bucket long, batch long, ids binary, counts binary, hashes binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(meet, "batch long, known binary")
    result = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        cut,
        f"doc_id long{carried}, n_words long, n_removed long, "
        "removed array<struct<start: long, end: long>>, kept string",
    )
    return restored(result, carry)


def _turn(h, bits: int, more: int):
    """The ``more`` bits of the hashes after the leading ``bits``."""
    return (h << np.uint64(bits)) >> np.uint64(64 - more)


def _later(h, doc, batch):
    """Batch and hash, by batch, of the windows that a smaller doc_id holds too."""
    order = np.lexsort((doc, h))
    h, doc, batch = h[order], doc[order], batch[order]
    first = np.r_[True, h[1:] != h[:-1]][:len(h)]
    late = doc > doc[np.flatnonzero(first)][np.cumsum(first) - 1]
    h, batch = h[late], batch[late]
    by = np.argsort(batch, kind="stable")
    return batch[by], h[by]


def _windows(table: pa.Table, width: int):
    """Rows in order of doc_id, each with its window hashes, and all doc_ids."""
    ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    column = table.column("text")
    return ids, [
        (int(row), rolling(hashes(split_words(column[int(row)].as_py())), width)) for row in order
    ]


def _flat(ids, found):
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    doc = np.repeat(ids[[row for row, _ in found]], [len(w) for _, w in found])
    return np.concatenate([w for _, w in found]), doc


def _groups(h, doc):
    """The order by hash, then doc_id (the input is in order of doc_id), and where groups begin."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    return order, np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, bool)


def _runs(doc):
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    return doc[starts], np.diff(np.r_[starts, len(doc)])

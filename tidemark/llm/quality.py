"""Quality scores by nearest-neighbour voting among labelled documents in a latent space."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashes, restored, take, texts

WORDS, SHAPES, PROFILE = 2048, 1024, 128
BLOCKS = (slice(0, WORDS), slice(WORDS, WORDS + SHAPES), slice(WORDS + SHAPES, None))
WIDTH = WORDS + SHAPES + PROFILE
SAMPLE = 4000
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 4
BLOCK = 512

_SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and term frequencies of a whole text.

    Three groups: lower-cased words, hashed; word shapes (letters, capitals and digits as one
    sign each, runs as one), hashed; and one term per measured trait of the text: length,
    share of different words, of words equal to the one before, of repeated lines, of capitals,
    of signs, and mean word length, each in steps.
    """
    raw = text.encode() if text else b""
    words = raw.split()
    n = len(words)
    h = hashes(list(map(bytes.lower, words))) % np.uint64(WORDS)
    index, count = np.unique(h.astype(np.int64), return_counts=True)
    shapes = Counter(_RUN.sub(rb"\1", raw.translate(_SHAPE)).split())
    if shapes:
        found = hashes(list(shapes)) % np.uint64(SHAPES)
        tally = np.bincount(found.astype(np.int64), weights=list(shapes.values()))
        at = np.flatnonzero(tally)
        index, count = np.r_[index, WORDS + at], np.r_[count, tally[at]]
    lines = raw.split(b"\n")
    plain = raw.translate(_SHAPE)
    size = max(1, len(raw))
    signs = size - sum(plain.count(c) for c in (b"a", b"A", b"0", b" ", b"\n"))
    traits = (
        n.bit_length(),
        10 * len(set(words)) / max(1, n),
        10 * sum(map(eq, words, words[1:])) / max(1, n),
        10 * (1 - len(set(lines)) / len(lines)),
        10 * plain.count(b"A") / size,
        30 * signs / size if raw else 0,
        len(raw) / max(1, n),
    )
    profile = [WORDS + SHAPES + 16 * i + min(15, int(t)) for i, t in enumerate(traits)]
    return (
        np.r_[index, profile].astype(np.int64),
        np.r_[np.log1p(count), np.ones(len(profile))].astype(np.float32),
    )


@dataclass
class Model:
    """What voting needs: bounded by the sample, whatever the size of the corpus."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float


def _dense(rows, idf) -> np.ndarray:
    x = np.zeros((len(rows), WIDTH), np.float32)
    for i, (index, value) in enumerate(rows):
        x[i, index] = value * idf[index]
    for block in BLOCKS:
        length = np.linalg.norm(x[:, block], axis=1, keepdims=True)
        x[:, block] /= np.where(length > 0, length, 1)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def document_counts(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows there are, and how many hold each feature. A task sends its sums once."""
    def count(batches):
        seen = np.zeros(WIDTH + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen[features(text)[0]] += 1
            seen[WIDTH] += batch.num_rows
        yield pa.record_batch({"i": pa.array(np.arange(WIDTH + 1)), "n": pa.array(seen)})

    sums = texts(docs).select("text").mapInArrow(count, "i long, n long").groupBy("i").agg(
        F.sum("n").alias("n")).collect()
    seen = np.zeros(WIDTH + 1, np.int64)
    for i, n in sums:
        seen[i] = n
    return int(seen[WIDTH]), seen[:WIDTH]


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality",
    sample: int = SAMPLE, rank: int = RANK,
) -> Model:
    """Latent vectors of labelled documents.

    Learns from at most ``sample`` documents with a label of 0 or 1 whose crc32(doc_id as text)
    leaves no remainder of 1 by 3; the sample is the ids with the smallest hash. A doc_id with
    both labels counts as 0; one with several texts is learnt from one of them. Inverse document
    frequencies are counted over all documents, with labels or without; the axes (a truncated
    singular value decomposition) come from the sample.
    Without any labelled document, every score is 0.5.
    """
    chosen = (
        take(labels, "doc_id", label).select(F.col("doc_id").cast("long"), F.col(label).alias("y"))
        .filter("y IN (0, 1) AND doc_id IS NOT NULL AND crc32(CAST(doc_id AS STRING)) % 3 != 1")
        .groupBy("doc_id").agg(F.min("y").cast("long").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    learnt = texts(docs).join(F.broadcast(chosen), "doc_id")

    def sparse(batches):
        for batch in batches:
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "y": batch.column("y"),
                "i": pa.array([f[0].astype(np.uint16).tobytes() for f in found], pa.binary()),
                "v": pa.array([f[1].tobytes() for f in found], pa.binary()),
            })

    rows = (
        learnt.select("doc_id", "text", "y")
        .mapInArrow(sparse, "doc_id long, y long, i binary, v binary")
        .groupBy("doc_id").agg(F.min(F.struct("i", "v", "y")).alias("row")).collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        return Model(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32),
                     np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5)
    found = [
        (np.frombuffer(r["row"]["i"], np.uint16).astype(np.int64),
         np.frombuffer(r["row"]["v"], np.float32)) for r in rows
    ]
    y = np.array([r["row"]["y"] for r in rows], np.float32)
    total, seen = document_counts(docs)
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)
    x = _dense(found, idf)
    axes = _axes(x, min(rank, *x.shape))
    return Model(idf, axes, _unit(x @ axes), y, float(y.mean()))


def _axes(x: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors, by repeated multiplication of a random start."""
    start = np.random.default_rng(seed).standard_normal((x.shape[1], min(x.shape[1], rank + 16)))
    q = start.astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray(q @ v[:rank].T, dtype=np.float32)


def vote(model: Model, found, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """The mean label of the nearest labelled vectors, weighted by cosine (negative: 0) ** 4.

    The cosines with all labelled vectors are one product per block of documents. Where no
    neighbour has a positive cosine, the score is the mean of all labels.
    """
    if not len(model.labels):
        return np.full(len(found), model.base)
    scores = []
    for at in range(0, len(found), BLOCK):
        near = _unit(_dense(found[at:at + BLOCK], model.idf) @ model.axes) @ model.vectors.T
        k = min(neighbours, near.shape[1])
        top = np.argpartition(near, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64)
        weight **= SHARPNESS
        total = weight.sum(axis=1)
        mean = (weight * model.labels[top]).sum(axis=1) / np.where(total > 0, total, 1)
        scores.append(np.where(total > 0, mean, model.base))
    return np.clip(np.concatenate(scores), 0, 1) if scores else np.empty(0)


def classify(
    docs: DataFrame, model: Model, carry: tuple[str, ...] = (), keep_text: bool = False,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """Per row: doc_id, text if kept, carried columns, score (0 to 1) and predicted (0 or 1).

    Scores depend on the whole text alone; a null text counts as empty. An empty table gives no
    rows. The model is broadcast: at most a few MB, as its sample is bounded.
    """
    rows = texts(docs, *carry)
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.idf, model.axes, model.vectors, model.labels, model.base)
    )

    def score(batches):
        learnt = Model(*shared.value)
        for batch in batches:
            column = batch.column("text").to_pylist()
            values = np.concatenate([np.empty(0)] + [
                vote(learnt, [features(t) for t in column[at:at + BLOCK]], neighbours)
                for at in range(0, len(column), BLOCK)
            ])
            if not keep_text:
                batch = batch.drop_columns(["text"])
            batch = batch.append_column("score", pa.array(values, pa.float64()))
            yield batch.append_column("predicted", pa.array((values >= 0.5).astype(np.int32)))

    kinds = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in rows.schema
        if keep_text or f.name != "text"
    )
    return restored(rows.mapInArrow(score, f"{kinds}, score double, predicted int"), carry)

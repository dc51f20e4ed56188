import zlib

import numpy as np
from helpers import ROWS, SF_DIR, empty, sample, small

from tidemark.llm.quality import (
    WIDTH,
    Model,
    _dense,
    _unit,
    classify,
    document_counts,
    features,
    fit,
    vote,
)
from tidemark.llm.queries import op10_quality

SF2 = SF_DIR.replace("sf0.001", "sf0.01")


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"]
              for r in spark.read.parquet(f"{SF2}/labels.parquet").collect()}
    rows = op10_quality(spark, SF2).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert len(held) > 50 and right >= 0.97 * len(held)


def test_frequencies_cover_all_documents(spark):
    for df in (small(spark), sample(spark), small(spark).repartition(7), empty(spark)):
        found = [features(r["text"])[0] for r in df.collect()]
        total, seen = document_counts(df)
        plain = np.bincount(np.concatenate([np.empty(0, np.int64), *found]), minlength=WIDTH)
        assert total == len(found) and (seen == plain).all()


def test_votes_against_a_plain_search(spark):
    model = fit(sample(spark), sample(spark, "labels"))
    found = [features(r[0]) for r in sample(spark).select("text").limit(60).collect()]
    found += [features(r[1]) for r in ROWS]
    points = _unit(_dense(found, model.idf) @ model.axes)
    for point, score in zip(points, vote(model, found)):
        near = sorted(range(len(model.labels)), key=lambda i: -float(point @ model.vectors[i]))[:15]
        weight = [max(0.0, float(point @ model.vectors[i])) ** 4 for i in near]
        plain = sum(w * model.labels[i] for w, i in zip(weight, near)) / sum(weight)
        assert abs(score - plain) < 1e-3


def test_axes_are_the_leading_singular_vectors(spark):
    model = fit(sample(spark), sample(spark, "labels"), rank=8)
    labelled = sample(spark, "labels").filter(
        "crc32(CAST(doc_id AS STRING)) % 3 != 1").select("doc_id")
    found = [features(r["text"]) for r in sample(spark).join(labelled, "doc_id").collect()]
    x = _dense(found, model.idf).astype(np.float64)
    best = np.linalg.svd(x, compute_uv=False)[:8]
    assert np.allclose(np.linalg.norm(x @ model.axes), np.linalg.norm(best), rtol=1e-2)


def test_only_learnt_rows_matter(spark):
    """Labels of held-out rows, and columns other than the text, change no score."""
    labels = sample(spark, "labels")
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - quality, quality) AS quality")
    docs = sample(spark)
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'zz' AS source", "1L AS n_chars")
    one = sorted(map(tuple, classify(docs, fit(docs, labels)).collect()))
    two = sorted(map(tuple, classify(other, fit(other, flipped)).collect()))
    assert one == two


def test_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (6, 1), (7, None), (None, 1), (1, 1), (9, 2)],
        "doc_id long, quality int")
    docs = small(spark)
    got = classify(docs, fit(docs, labels), carry=("source",), keep_text=True)
    assert got.columns == ["doc_id", "text", "source", "score", "predicted"]
    assert got.count() == len(ROWS)
    assert classify(empty(spark), fit(empty(spark), labels)).collect() == []
    nothing = fit(docs, labels.limit(0))
    assert {r["score"] for r in classify(docs, nothing).collect()} == {0.5}
    assert isinstance(nothing, Model) and len(nothing.labels) == 0
    able = [d for d in range(1, 7) if zlib.crc32(str(d).encode()) % 3 != 1]
    for sample in (1, 2, 6):
        assert len(fit(docs, labels, sample=sample).labels) == min(sample, len(able))

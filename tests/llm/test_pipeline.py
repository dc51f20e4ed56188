"""The whole pipeline and each stage against plain versions, on the smallest tables."""

from collections import Counter, defaultdict

import pytest
from helpers import SF_DIR, empty, sample, small, words
from test_dedup import classes, plain_fingerprint, removal
from test_mixing import targets
from test_packing import check

import corpus_pipeline
from tidemark.llm.common import take


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first and after every stage."""
    docs, out = sample(spark), [sample(spark).collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        rows = docs.collect()
        out.append(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_columns_stay(stages):
    for rows in stages[:-1]:
        assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


def test_filter_keeps_clean_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in sample(spark, "labels").collect()}
    kept = {r["doc_id"] for r in stages[1]}
    assert {d for d, q in labels.items() if q} - kept == set()
    assert sum(not q for d, q in labels.items() if d in kept) <= 1
    whole = {r["doc_id"]: r for r in stages[0]}
    assert all(whole[r["doc_id"]] == r for r in stages[1])


def test_one_of_each_group_stays(stages):
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in stages[1]}
    root, least = classes(fps.values()), {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(least.values())


def test_repeats_are_cut(stages):
    texts = [(r["doc_id"], r["text"]) for r in stages[2]]
    got = {r["doc_id"]: r for r in stages[3]}
    for (doc, text), (_, removed, kept) in zip(texts, removal(texts, 13)):
        assert got[doc]["text"] == (kept if removed else text)
        assert got[doc]["n_chars"] == len(got[doc]["text"])
    assert len(got) == len(texts)


def test_mix_follows_targets(stages):
    sizes, of = defaultdict(int), {}
    for r in stages[3]:
        sizes[r["source"]] += len(words(r["text"]))
        of[r["doc_id"]] = words(r["text"])
    got, copies = Counter(), defaultdict(list)
    for r in stages[4]:
        w = words(r["text"])
        got[r["source"]] += len(w)
        copies[r["doc_id"]].append(len(w))
        assert w == of[r["doc_id"]][:len(w)]
    for source, target in targets(dict(sizes)).items():
        assert abs(got[source] - target) <= 1
    for doc, lengths in copies.items():
        assert sum(n != len(of[doc]) for n in lengths) <= 1 and len(lengths) <= 3


def test_packing_holds_every_piece(stages):
    check(stages[5], [(r["doc_id"], r["text"]) for r in stages[4]])


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r[:5] for r in map(tuple, rows)) == Counter(
        r[:5] for r in map(tuple, stages[5]))


def test_awkward_rows_pass_all_stages(spark):
    for df in (small(spark), empty(spark)):
        extra = ["batch", "k0", "fp", "size", "score", "predicted", "kept", "o5"]
        docs = take(df, "doc_id", "text", "lang", "source", "n_chars").selectExpr(
            "*", *[f"'x' AS {name}" for name in extra])
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.columns[5:] == extra
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count()

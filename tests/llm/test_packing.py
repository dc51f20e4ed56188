import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import ROWS, SF_DIR, empty, sample, small

from tidemark.llm import packing
from tidemark.llm.queries import op1_pack


@cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected_ids(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts, capacity=1024):
    """Pieces rebuild their documents and fill their sequences without gap or overlap."""
    want = []
    for doc, text in texts:
        ids = np.array(expected_ids(text), "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((doc, i, a, b - a, ids[a:b].tobytes()))
    got = [(*tuple(r)[:4], bytes(r["ids"])) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    at = {}
    for r in rows:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def test_ids_of_both_files_are_equal(spark):
    import public_tokenizers

    texts = [r[0] for r in sample(spark).select("text").collect()] + [r[1] or "" for r in ROWS]
    texts += ["<|endoftext|>"[:6], "a b  c", "  x  \n\n y", "\U0001f600‍́"]
    made = []
    for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"):
        with open(public_tokenizers.path(name), "rb") as f:
            encode = packing.encoder(f.read(), "." + name.rsplit(".", 1)[1])
        made.append([encode(t).tolist() for t in texts])
    assert made[0] == made[1]


def test_small_and_sampled_rows(spark):
    rows = packing.pack(small(spark)).collect()
    check(rows, [(r[0], r[1]) for r in ROWS])
    docs = sample(spark)
    rows = packing.pack(docs).collect()
    made = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert made <= 1.02 * least + 1


def test_reruns_agree_and_shards_do_not_lose_rows(spark):
    docs = sample(spark)
    one, two = (sorted(map(tuple, packing.pack(docs, rows_per_shard=50).collect()))
                for _ in range(2))
    assert one == two
    assert len(one) == packing.pieces(docs).count()


def test_query_derives_its_digest_from_the_ids(spark):
    docs = sample(spark)
    want = Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"])))
        for r in packing.pack(docs).collect()
    )
    rows = op1_pack(spark, SF_DIR)
    assert rows.columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]
    assert Counter(tuple(r)[:5] for r in rows.collect()) == want


def test_empty(spark):
    assert packing.pack(empty(spark)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60), st.integers(1, 6))
def test_best_fit_against_a_plain_search(lengths, most):
    """Places as a search through all open bins does: fullest that fits, fullest closes."""
    bins, open_bins, made = packing.OpenBins(16, most), [], 0
    for length in lengths:
        name, offset = bins.place(length)
        fits = [b for b in open_bins if b[0] >= length]
        if fits:
            best = min(b[0] for b in fits)
            chosen = next(b for b in open_bins if b[1] == name)
            assert chosen[0] == best and offset == 16 - best
            chosen[0] -= length
        else:
            assert (name, offset) == (made, 0)
            if len(open_bins) == most:
                least = min(b[0] for b in open_bins)
                closed = [b for b in open_bins if b[0] == least]
                kept = {n for stack in bins.bins for n in stack}
                gone = [b for b in closed if b[1] not in kept]
                assert len(gone) == 1
                open_bins.remove(gone[0])
            open_bins.append([16 - length, made])
            made += 1
        open_bins = [b for b in open_bins if b[0]]
        assert bins.open == len(open_bins) <= most


@pytest.mark.parametrize("capacity", [8, 1024])
def test_capacity(spark, capacity):
    texts = [(r[0], r[1]) for r in ROWS if r[0] not in (7, 8)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check(packing.pack(df, capacity=capacity).collect(), texts, capacity)

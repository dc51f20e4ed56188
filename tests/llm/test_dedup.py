import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import ROWS, empty, key, sample, small, words

from tidemark.llm.common import NO_ID, hashes, rolling, take
from tidemark.llm.simhash_dedup import (
    BKTree,
    components,
    deduplicated,
    links,
    near_duplicates,
)
from tidemark.llm.substring_dedup import substring_dedup


def removal(texts, window):
    """Kept words and removed count of each row, by looking every window up."""
    least = {}
    ids = [NO_ID if d is None else d for d, _ in texts]
    split = [words(t) for _, t in texts]
    for doc, w in zip(ids, split):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(doc, least.get(k, NO_ID))
    out = []
    for doc, w in zip(ids, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("options", [
    {}, {"batch_chars": 3000, "bucket_windows": 500},
    {"batch_chars": 3000, "bucket_windows": 50, "most_bits": 1},
    {"batch_chars": 3000, "bucket_windows": 500, "most_bits": 0},
])
def test_substrings_against_brute_force(spark, options):
    for df in (small(spark), sample(spark)):
        texts = [(r[0], r[1]) for r in take(df, "doc_id", "text").collect()]
        got = substring_dedup(df, **options).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got),
                      key=key) == sorted(
            ((d, *x) for (d, _), x in zip(texts, removal(texts, 13))), key=key)
        for r in got:
            assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
            ends = [s["end"] for s in r["removed"]]
            assert all(s["start"] > e for s, e in zip(r["removed"][1:], ends))


def test_many_copies_of_a_passage(spark):
    rows = [(i, f"before{i} " + " ".join(f"p{j}" for j in range(20)) + f" after{i}")
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"]
           for r in substring_dedup(df, batch_chars=1000).collect()}
    assert got == {i: 20 if i else 0 for i in range(300)}


def test_untouched_texts_can_stay_as_they_are(spark):
    got = {r["doc_id"]: r["kept"] for r in
           substring_dedup(sample(spark), carry=("source",), rejoin=False).filter("n_removed = 0")
           .collect()}
    texts = {r["doc_id"]: r["text"] for r in sample(spark).collect()}
    assert got and all(texts[d] == t for d, t in got.items())


def test_substrings_of_nothing(spark):
    assert substring_dedup(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        substring_dedup(small(spark), carry=("text",))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab"]), max_size=30), st.integers(1, 6))
def test_equal_windows_have_equal_hashes(parts, width):
    found = rolling(hashes(parts), width)
    seen = {}
    for i, h in enumerate(found.tolist()):
        assert seen.setdefault(h, parts[i:i + width]) == parts[i:i + width]
    assert len(set(found.tolist())) == len({tuple(parts[i:i + width]) for i in range(len(found))})


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return 0
    parts = [" ".join(w)] if len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    ones = Counter()
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def classes(fps, radius=3):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_near_duplicates_against_brute_force(spark):
    for df in (small(spark), sample(spark)):
        rows = [(r[0], plain_fingerprint(r[1])) for r in take(df, "doc_id", "text").collect()]
        root, least = classes([f for _, f in rows]), {}
        for d, f in rows:
            if d is not None:
                least[root[f]] = min(d, least.get(root[f], d))
        want = sorted(((d, f"{f:016x}", least.get(root[f])) for d, f in rows), key=key)
        assert sorted(map(tuple, near_duplicates(df).collect()), key=key) == want
        kept = deduplicated(df, carry=("source",)).collect()
        assert len(kept) == len(set(root.values()))
        assert {plain_fingerprint(r["text"]) for r in kept} <= {f for _, f in rows}
        assert len({root[plain_fingerprint(r["text"])] for r in kept}) == len(kept)
    assert near_duplicates(empty(spark)).collect() == []
    assert deduplicated(empty(spark)).collect() == []


def test_rows_of_one_id_that_differ(spark):
    """The same one of them stays, whatever the order and partitions of the rows."""
    rows = [(1, "one text of a few words", f"s{i}") for i in range(20)] + [(2, "another", "s")]
    kept = {
        tuple(sorted(map(tuple, deduplicated(
            spark.createDataFrame(given, "doc_id long, text string, fp string").repartition(n),
            carry=("fp",),
        ).collect())))
        for given, n in ((rows, 1), (rows[::-1], 3), (rows + rows, 5))
    }
    assert len(kept) == 1 and [r[0] for r in kept.pop()] == [1, 2]


def test_links_in_dense_groups_and_small_shards(spark):
    """Fingerprints in chains and balls: whatever the shards, the classes are the same."""
    rng = np.random.default_rng(3)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(6):
        now = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(60):
            for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                now ^= 1 << int(bit)
            fps.add(now)
            fps.add(now ^ 1 << int(rng.integers(0, 64)))
    want = classes(list(fps))
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    nodes = spark.createDataFrame(signed, "fp long")
    for shard in (2048, 5):
        roots = {r["node"]: r["root"] for r in components(links(nodes, shard=shard)).collect()}
        found = {}
        for f in fps:
            s = int(np.uint64(f).astype(np.int64))
            found.setdefault(roots.get(s, s), set()).add(f)
        expected = {}
        for f in fps:
            expected.setdefault(want[f], set()).add(f)
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 255), max_size=40), st.integers(0, 255), st.integers(0, 8))
def test_tree_finds_all_within(values, asked, radius):
    tree = BKTree()
    for v in values:
        tree.add(v)
    assert sorted(tree.within(asked, radius)) == sorted(
        {v for v in values if (v ^ asked).bit_count() <= radius}
    )


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {(r["node"], r["root"]) for r in components(edges).collect()} == {
        (i, 0) for i in range(201)
    }


def test_registered_digest(spark):
    from tidemark.llm.queries import op5_substring_dedup
    from helpers import SF_DIR

    texts = [(r["doc_id"], r["text"]) for r in sample(spark).collect()]
    want = {(d, n, g, hashlib.sha256(k.encode()).hexdigest())
            for (d, _), (n, g, k) in zip(texts, removal(texts, 13))}
    assert {tuple(r) for r in op5_substring_dedup(spark, SF_DIR).collect()} == want

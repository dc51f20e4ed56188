import hashlib

import numpy as np
from helpers import ROWS, empty, sample, small

from tidemark.llm.common import take
from tidemark.llm.minhash import Fingerprinter, against_next, fingerprints


def jaccard(a, b):
    def shingles(text):
        w = text.split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def plain_values(text, maker):
    """Bins, minima and densification written out, from the same hashes."""
    from tidemark.llm.common import hashes, mixed, rolling, split_words

    w = split_words(text)
    h = rolling(hashes(w), min(5, len(w))) if w else mixed(np.array([1], np.uint64))
    least = {}
    for x in h.tolist():
        b = x >> int(maker.shift)
        least[b] = min(x, least.get(b, x))
    out = []
    for b in range(maker.bins):
        at, tries = b, 0
        while at not in least:
            seed = np.array([tries * maker.bins + b], np.uint64) + np.uint64(0x5851F42D4C957F2D)
            at, tries = int(mixed(seed)[0]) >> int(maker.shift), tries + 1
        salted = np.array([least[at] ^ int(maker.salt[b])], np.uint64)
        out.append(int(mixed(salted)[0]) & (1 << maker.bits) - 1)
    return out


def test_values_against_a_plain_version(spark):
    maker = Fingerprinter()
    texts = [r[0] for r in sample(spark).select("text").limit(30).collect()]
    for text in texts + [r[1] for r in ROWS if r[0] not in (7, 8)]:
        assert maker.values(text).tolist() == plain_values(text, maker)
    assert len(bytes.fromhex(maker.pack(maker.values("a b")))) == 128


def test_texts_of_one_shingle_differ():
    maker = Fingerprinter()
    values = [maker.values(t) for t in ("", "short", "other", "a b", "a b c")]
    for i, a in enumerate(values):
        for j, b in enumerate(values):
            assert maker.likeness(a, b) == 1 if i == j else maker.likeness(a, b) < 0.2


def test_likeness_is_near_the_jaccard_similarity():
    maker, rng = Fingerprinter(), np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    errors = []
    for share in (0, 0.2, 0.5, 0.8, 1):
        for n in (40, 300, 3000):
            base = list(rng.choice(words, n))
            other = base[:int(n * share)] + list(rng.choice(words, n - int(n * share)))
            a, b = " ".join(base), " ".join(other)
            errors.append(maker.likeness(maker.values(a), maker.values(b)) - jaccard(a, b))
    assert max(map(abs, errors)) < 0.15 and abs(np.mean(errors)) < 0.04


def expected(rows):
    """Results from neighbours in descending order of doc_id."""
    maker = Fingerprinter()
    out = []
    for i, (doc, text) in enumerate(rows):
        text, other = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        a, b, c = maker.values(text), maker.values(edited), maker.values(other)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), maker.pack(a),
                    maker.pack(b), maker.likeness(a, b), maker.likeness(a, c)))
    return out


def test_neighbours_against_a_plain_version(spark):
    for df in (small(spark), sample(spark).repartition(7)):
        rows = [(r[0], r[1]) for r in take(df, "doc_id", "text").filter("doc_id IS NOT NULL")
                .collect()]
        rows.sort(key=lambda r: -r[0])
        df = take(df, "doc_id", "text").filter("doc_id IS NOT NULL")
        assert sorted(map(tuple, against_next(df).collect())) == sorted(expected(rows))
    one = spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")
    assert [tuple(r) for r in against_next(one).collect()] == expected([(5, "a b c d")])
    assert against_next(empty(spark)).collect() == []


def test_null_ids_come_last(spark):
    rows = against_next(small(spark)).collect()
    assert len(rows) == len(ROWS)
    assert sum(r["doc_id"] is None for r in rows) == 2


def test_equal_texts(spark):
    got = fingerprints(small(spark), carry=("source",)).collect()
    marks = {}
    for r in got:
        marks.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert len(marks[9]) == 1 and marks[3] == marks[4] == marks[5]
    assert len(marks[6] | marks[4]) == 2
    assert fingerprints(empty(spark)).collect() == []

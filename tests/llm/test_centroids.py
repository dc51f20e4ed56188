import hashlib
import math

import numpy as np
import pytest
from helpers import sample

from tidemark.llm.centroids import assign, candidates, cluster, hilbert

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, size=64, clusters=8, rounds=10):
    kept = [
        (i, [math.floor(1024 * c) for c in v]) for i, v in rows
        if v is not None and len(v) == size
        and all(c is not None and math.isfinite(c) for c in v)
    ]
    first = sorted(
        (r for r in kept if r[0] is not None),
        key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]),
    )
    now = [v for _, v in (first + [r for r in kept if r[0] is None])[:clusters]]

    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest():
        return [min((distance(v, c), n) for n, c in enumerate(now)) for _, v in kept]

    for _ in range(rounds):
        own = nearest()
        for n in range(len(now)):
            mine = [v for (_, v), (_, m) in zip(kept, own) if m == n]
            if mine:
                now[n] = [sum(c) // len(mine) for c in zip(*mine)]
    own = nearest()
    within = [sum(d for d, m in own if m == n) for n in range(len(now))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted((
        (i, n, d, within[n], sum(within), names[n]) for (i, _), (d, n) in zip(kept, own)
    ), key=repr)


def found(df, **options):
    return sorted(map(tuple, cluster(df, **options).collect()), key=repr)


@pytest.mark.parametrize("rows_per_block", [1, 7, 128, 1000])
def test_agrees_with_plain_rounds(spark, rows_per_block):
    df = sample(spark, "embeddings").select("vec_id", "embedding")
    want = brute([tuple(r) for r in df.collect()])
    assert found(df, rows_per_block=rows_per_block) == want


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    one, half = [1.0] * 64, [0.5] * 63 + [-0.25]
    rows = [
        (1, one), (1, one), (2, half), (2, [9.0] * 64), (3, None), (4, []), (5, [1.0] * 63),
        (6, [None] + [1.0] * 63), (7, [nan] + [1.0] * 63), (8, [inf] + [1.0] * 63),
        (None, [0.0] * 64), (9, [-0.0001] * 64), (10, [100_000.0] * 64), (11, [2.0**-30] * 64),
        (12, half), (13, [-2000.0] * 64), (14, [1.5] * 64),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS cluster", "2 AS VEC_ID", "3 AS place", "4 AS id", "5 AS x"
    )
    assert found(df) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None), (2, [1.0])], SCHEMA)) == []
    assert found(spark.createDataFrame(rows[:1], SCHEMA)) == brute(rows[:1])


def test_many_copies_of_one_vector(spark):
    rows = [(i, [0.25] * 64) for i in range(3000)] + [(5000 + i, [i / 10] * 64) for i in range(30)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_the_curve_goes_from_neighbour_to_neighbour():
    for axes, bits in ((2, 4), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), axis=-1).reshape(-1, axes)
        keys = hilbert(cells, bits)
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_out_only_centroids_that_are_nearest_to_nothing():
    rng = np.random.default_rng(4)
    left_out = 0
    for spread in (3, 40, 1000, 1 << 26):
        for _ in range(30):
            middle = rng.integers(-spread, spread, 64)
            x = middle + rng.integers(-9, 9, (20, 64))
            centroids = rng.integers(-spread, spread, (8, 64))
            centroids[5] = centroids[2]
            maybe = candidates(x.min(axis=0), x.max(axis=0), centroids)
            left_out += 8 - len(maybe)
            squared = ((x[:, None] - centroids) ** 2).sum(axis=2)
            own, distance = assign(x, centroids)
            assert (own == squared.argmin(axis=1)).all()
            assert (distance == squared.min(axis=1)).all()
    assert left_out > 0

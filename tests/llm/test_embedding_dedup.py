import numpy as np
import pytest
from helpers import sample

from tidemark.llm.embedding_dedup import Forest, near_copies

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """Links and components by comparing every two rows of one label."""
    def unit(v):
        if v is None or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        return v / np.sqrt(v @ v)

    units = [None if label is None else unit(v) for _, v, label in rows]
    near = [[] for _ in rows]
    for i, u in enumerate(units):
        for j in range(i):
            w = units[j]
            if u is None or w is None or len(u) != len(w) or rows[i][2] != rows[j][2]:
                continue
            if u @ w >= threshold:
                near[i].append(j)
                near[j].append(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in group:
                    group.add(j)
                    stack.append(j)
        seen |= group
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(near[j]), least, rows[j][0] == least)
    return sorted(out, key=repr)


def found(df, **options):
    return sorted(map(tuple, near_copies(df, **options).collect()), key=repr)


def planted(n=600, labels=2, seed=5):
    """Independent vectors, chains of near copies and one tight group that no cut separates."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 24))
    for i in range(0, n, 3):
        x[i + 1] = x[i] + rng.standard_normal(24) * rng.uniform(0.1, 0.45)
    x[n // 2:] = x[0] + rng.standard_normal((n - n // 2, 24)) * 0.25
    return [(int(i), x[i].astype(np.float32).tolist(), int(i % labels)) for i in range(n)]


@pytest.mark.parametrize("options", [
    {}, {"leaf": 20, "spill": 1.5}, {"leaf": 40, "block": 16, "spill": 1.0},
    {"leaf": 300, "block": 7},
])
def test_agrees_with_all_pairs(spark, options):
    rows = planted()
    assert found(spark.createDataFrame(rows, SCHEMA), **options) == brute(rows)


def test_whole_sample_agrees_with_all_pairs_at_a_low_threshold(spark):
    df = sample(spark, "embeddings")
    rows = [tuple(r) for r in df.collect()]
    want = brute(rows, 0.4)
    assert sum(r[1] for r in want) > 0
    assert found(df, threshold=0.4) == want


def test_few_trees_miss_and_many_find(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2000, 32))
    x[1000:] = x[:1000] + rng.standard_normal((1000, 32)) * 0.3
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    links = sum(r[1] for r in brute(rows)) // 2
    df = spark.createDataFrame(rows, SCHEMA)

    def recall(**options):
        return sum(r[1] for r in found(df, leaf=32, **options)) / 2 / links

    few, some, many = recall(trees=1, spill=0.0), recall(trees=1), recall()
    assert few < some < many and many > 0.99


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (7, [1.0, 0.0], 1), (3, [2.0, 0.01], 1), (9, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (10, [inf, 0.0], 1),
        (11, [1.0, None], 1), (12, [1.0], 1), (13, [], 1), (14, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (3, [2.0, 0.01], 1), (15, [1e-38, 0.0], 1),
        (16, [3e38, 3e38], 1), (17, [-3e38, 3e38], 1), (None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS node", "2 AS VEC_ID", "3 AS k1", "4 AS links", "5 AS size"
    )
    assert found(df) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_copies_are_one_class(spark):
    rows = [(i, [1.0, 0.0], 1) for i in range(5000)] + [(9000, [0.99, 0.1], 1)]
    got = found(spark.createDataFrame(rows, SCHEMA), block=4)
    assert {r[1:3] for r in got} == {(5000, 0)} and sum(r[3] for r in got) == 1


def test_labels_of_text_and_vectors_of_doubles(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.1], "a"), (3, [1.0, 0.0], "b")]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string")
    assert found(df) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_a_pair_within_the_overlap_shares_a_leaf():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    # So wide an overlap that no linked pair can be parted at any cut.
    forest = Forest(x, 0.3, 1, 2 * 16**0.5 / 2)
    y = x + 0.29 / 16**0.5 * rng.choice([-1, 1], x.shape)
    depth = np.full(len(x), 3)
    one, other = (list(zip(*forest.leaves(z, depth))) for z in (x, y))
    for i in range(len(x)):
        assert {leaf for row, leaf in one if row == i} & {leaf for row, leaf in other if row == i}

from collections import defaultdict

from helpers import ROWS, SF_DIR, empty, sample, small, words

from tidemark.llm.mixing import mix, mixed_documents
from tidemark.llm.queries import op4_mix


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, the excess over the limit given to the others, round by round."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in order}
        full |= more


def check(rows, docs):
    sizes, source_of = defaultdict(int), {}
    for doc, text, source in docs:
        sizes[source] += len(words(text))
        source_of.setdefault((doc, len(words(text))), set()).add(source)
    want, taken = targets(dict(sizes)), defaultdict(int)
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted(
        (str(d), len(words(t))) for d, t, _ in docs
    )
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert any(abs(want[s] - r["target"]) < 1e-6 and sizes[s] == r["source_size"]
                   for s in source_of[r["doc_id"], r["size"]])
        taken[r["target"], r["source_size"]] += r["taken"]
    for (target, size), n in taken.items():
        same = sum(1 for s in want if abs(want[s] - target) < 1e-6 and sizes[s] == size)
        assert abs(n - same * target) <= same


def test_targets_and_budgets(spark):
    check(mix(small(spark)).collect(), [(r[0], r[1], r[3]) for r in ROWS])
    docs = sample(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    one = mix(docs).collect()
    check(one, rows)
    assert sorted(one) == sorted(mix(docs.repartition(5), rows_per_bucket=7).collect())
    assert mix(empty(spark)).collect() == []


def test_many_small_sources(spark):
    rows = [(i, "a b c " * (i % 5), f"s{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(mix(df).collect(), rows)


def test_repeats_follow_what_is_taken(spark):
    mixed = mix(small(spark), carry=("size", "lang", "source", "n_chars"))
    assert mixed.columns[:5] == ["doc_id", "size", "lang", "source", "n_chars"]
    mixed = mix(small(spark))
    out = mixed_documents(small(spark), carry=("lang", "size", "n_chars"))
    assert out.columns == ["doc_id", "text", "lang", "size", "n_chars"]
    got = defaultdict(int)
    for r in out.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    want = defaultdict(int)
    for r in mixed.collect():
        want[r["doc_id"]] += r["taken"]
    assert dict(got) == {d: n for d, n in want.items() if n}


def test_plan_has_no_python(spark):
    plan = op4_mix(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

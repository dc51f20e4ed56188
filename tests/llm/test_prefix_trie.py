import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import SF_DIR, sample

from tidemark.llm.prefix_trie import Parentheses, prefix_trie
from tidemark.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, group=100, most=6):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            said[c].append(((turn is not None, turn or 0), role or "", text))
    whole = {}
    for c in said:
        said[c] = sorted(said[c], key=lambda s: (s[0], s[1], _key(s)))
    for c in list(said):
        h = zlib.crc32(str(c).encode()) % most
        turns = said.get(c - int(math.fmod(c, group)), [])[:h] + said[c][h:]
        whole[c] = tuple((role, text) for _, role, text in turns)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = (defaultdict(int) for _ in range(3))
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, held in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += not children[node]
    return sorted((
        (min(held), len(node), min(members[node[:-1]]) if node else None, len(held),
         children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, held in list(members.items())
    ), key=repr)


def _key(s):
    """Equal turn numbers and roles are ordered by a digest of role and text."""
    return hashlib.md5(f"{len(s[1])}:{s[1]}:{s[2]}".encode()).digest()


def found(df, **options):
    return sorted(map(tuple, prefix_trie(df, **options).collect()), key=repr)


def crowded(n=400, seed=1):
    """Few distinct turns, so that paths part late, end early and repeat whole."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, turn, "ab"[turn % 2], rng.choice(["x", "yy", "é\U0001f600z"])))
    return rows


@pytest.mark.parametrize("most_nodes", [1, 5, 40, 1 << 18])
def test_agrees_with_a_plain_trie(spark, most_nodes):
    rows = crowded()
    assert found(spark.createDataFrame(rows, SCHEMA), most_nodes=most_nodes) == brute(rows)


def test_supplied_conversations(spark):
    rows = [tuple(r) for r in sample(spark, "conversations").collect()]
    got = sorted(map(tuple, op12_prefix_trie(spark, SF_DIR).collect()), key=repr)
    assert got == brute(rows)


def test_awkward_rows(spark):
    long = "w " * 200_000
    rows = [
        (0, 1, "user", "a"), (0, 1, "user", "a"), (0, None, None, None), (0, 1, "user", "b"),
        (1, None, "user", None), (1, 2, None, ""), (2, 5, "user", long), (3, 5, "user", long),
        (None, 1, "user", "lost"), (100, 0, "", "x"), (205, 0, "a", "b:c"), (206, 0, "a:b", "c"),
        (207, 0, "a", "b:c"), (-7, 0, "user", "a"), (-7, 1, "user", "c"),
    ] + [(305, t, "user", "same") for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS c", "2 AS CONV_ID", "3 AS key", "4 AS depth", "5 AS node", "6 AS shard"
    )
    assert found(df) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(0, 30_000, 100) for t in range(7)]
    rows += [(c + 1, t, "user", f"t{t}") for c in range(0, 30_000, 100) for t in range(7)]
    assert found(spark.createDataFrame(rows, SCHEMA), most_nodes=50) == brute(rows)


def test_findclose_and_leaf_pairs():
    rng = random.Random(7)
    for n in (1, 2, 63, 64, 65, 500, 5000):
        for down in (0.2, 0.5, 0.95):
            bits, opened, left = [1], 1, n - 1
            while opened:
                if left and rng.random() < down:
                    bits.append(1)
                    opened, left = opened + 1, left - 1
                else:
                    if left and opened == 1:
                        bits.append(1)
                        opened, left = opened + 1, left - 1
                        continue
                    bits.append(0)
                    opened -= 1
            want, stack = {}, []
            for i, bit in enumerate(bits):
                if bit:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            tree = Parentheses(np.array(bits, np.uint8))
            assert dict(zip(tree.opens.tolist(), tree.findclose(tree.opens).tolist())) == want
            pairs = np.cumsum([bits[i:i + 2] == [1, 0] for i in range(len(bits))])
            assert (tree.leaf_pairs() == pairs).all()

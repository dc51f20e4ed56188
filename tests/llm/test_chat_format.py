from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import SF_DIR, sample

from tidemark.llm.chat_format import (
    LENGTHS,
    MARKERS,
    ROLES,
    STATES,
    Speakers,
    fit,
    format_chats,
    observed,
    recovered,
    render,
    transcripts,
)

SF2 = SF_DIR.replace("sf0.001", "sf0.01")


symbols = st.tuples(st.integers(0, MARKERS - 1), st.integers(0, 1), st.integers(0, LENGTHS - 1))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.lists(symbols, min_size=1, max_size=3))
def test_states_against_all_paths(seed, symbols):
    rng = np.random.default_rng(seed)
    sizes = (STATES, (STATES, STATES), (STATES, MARKERS), (STATES, 2), (STATES, LENGTHS))
    model = Speakers(*(np.log(rng.random(s)) for s in sizes))

    def score(path):
        total = model.start[path[0]]
        for i, (marker, blank, length) in enumerate(symbols):
            total += model.step[path[i - 1], path[i]] if i else 0
            total += model.marker[path[i], marker]
            total += model.blank[path[i], blank] + model.length[path[i], length]
        return total

    best = max(product(range(STATES), repeat=len(symbols)), key=score)
    assert np.isclose(score(model.states(symbols)), score(best))


def test_markers():
    for text, marker, content in (
        ("User: hi", 2, "hi"), ("**AI**: yes", 3, "yes"), ("### System: be kind", 1, "be kind"),
        ("[assistant]: x", 3, "x"), ("Users: many", 0, "Users: many"), ("user", 0, "user"),
        ("Tool: 3", 4, "3"), ("Answer: 42", 7, "42"), ("Context: sky", 5, "sky"),
    ):
        (line,) = observed(text)
        assert (line.marker, line.content, line.line) == (marker, content, text)
    assert observed(None) == observed("") == observed(" \n \n") == []


@pytest.fixture(scope="module")
def model(spark):
    return fit(transcripts(spark.read.parquet(f"{SF2}/conversations.parquet")))


@pytest.mark.parametrize("gap", ["\n", "\n\n", "\n\n\n"])
@pytest.mark.parametrize("system, user, assistant", [
    ("System: ", "User: ", "Assistant: "), ("### System: ", "### User: ", "### Assistant: "),
    ("**System**: ", "**Human**: ", "**AI**: "), ("[SYSTEM]: ", "[USER]: ", "[ASSISTANT]: "),
    ("<|system|>: ", "<|user|>: ", "<|assistant|>: "),
])
def test_transcripts_of_other_styles(model, gap, system, user, assistant):
    said = [
        ("system", system, "Be brief."), ("user", user, "What is a tide?"),
        ("assistant", assistant, "The sea, rising.\nTwice a day."), ("user", user, "Why?"),
        ("assistant", assistant, "The moon."),
    ]
    for first in (0, 1):
        text = gap.join(mark + words for _, mark, words in said[first:])
        assert model.turns(text) == [(role, words) for role, _, words in said[first:]]


def test_questions_and_answers(model):
    assert model.turns("Question: How high?\n\nAnswer: Two metres.") == [
        ("user", "How high?"), ("assistant", "Two metres.")
    ]


def test_words_that_look_like_markers_stay_inside_a_turn(model):
    for line in ("Context: the sky is blue", "Answer: 42 is in the book", "Q: is a letter"):
        body = f"Please look at this text of mine, it is not long.\n{line}\nand tell me more."
        text = f"User: {body}\nAssistant: I will."
        assert model.turns(text) == [("user", body), ("assistant", "I will.")]


def test_blank_lines_inside_a_turn_stay(model):
    body = "Here is some code of some length for you:\n```\na = 1\n\n\nb = 2\n```"
    text = f"User: Show me.\nAssistant: {body}\nUser: Thanks."
    got = model.turns(text)
    assert "".join(t for _, t in got).count("a = 1\n\n\nb = 2") == 1


@settings(max_examples=60, deadline=None)
@given(lines=st.lists(st.sampled_from([
    "User: a", "Assistant: b", "Answer: c", "Context: d", "Tool: e", "plain words", "", " ", "**AI**: f",
]), max_size=12))
def test_no_character_is_lost(model, lines):
    """All that can go is a marker at the start of a turn of its role, and blank lines."""
    text = "\n".join(lines)
    turns = model.turns(text)
    left = [line for line in observed(text)]
    for role, said in turns:
        for i, line in enumerate(x for x in said.split("\n") if x.strip()):
            want = left.pop(0)
            own = want.names(ROLES.index(role))
            assert line == want.line or (i == 0 and own and line == want.content)
    assert not left


def test_roles_of_held_out_conversations(spark):
    rows = recovered(spark.read.parquet(f"{SF2}/conversations.parquet")).filter(
        "crc32(CAST(conv_id AS STRING)) % 3 = 1"
    ).collect()
    assert len(rows) > 20
    assert sum(r["roles"] == r["true_roles"] for r in rows) >= 0.9 * len(rows)


def test_transcripts_of_awkward_rows(spark):
    rows = [
        (1, 0, "user", "hello\nthere"), (1, 1, "assistant", None), (1, 2, "user", ""),
        (1, 0, "user", "hello\nthere"), (2, 0, "robot", "x"), (None, 0, "user", "x"),
        (3, None, "user", "x"), (3, 1, "assistant", "y"), (4, 0, None, "x"),
        (5, 0, "user", "User: sly"),
    ] + [(6, i, "user" if i % 2 == 0 else "assistant", f"say {i}") for i in range(1100)]
    rows += [(7, 0, "user", "again")] * 600
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS chunk", "2 AS said", "3 AS ROLE")
    made = {(r["conv_id"], r["chunk"]): r for r in transcripts(df).collect()}
    assert {k: len(r["turns"]) for k, r in made.items()} == {
        (1, 0): 4, (2, 0): 1, (None, 0): 1, (3, 0): 2, (4, 0): 1, (5, 0): 1, (6, 0): 512,
        (6, 1): 512, (6, 2): 76, (7, 0): 512, (7, 1): 88,
    }
    assert [t["role"] for t in made[3, 0]["turns"]] == ["assistant", "user"]
    assert made[2, 0]["turns"][0]["role"] == made[4, 0]["turns"][0]["role"] == "other"
    assert recovered(df).count() == 11
    assert recovered(df.limit(0)).collect() == []


def test_rendered_text_holds_every_line(spark, model):
    made = transcripts(sample(spark, "conversations")).cache()
    docs = made.selectExpr("conv_id AS doc_id", "text", "1 AS roles", "2 AS TURNS")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in format_chats(docs, model).collect():
        said = "\n".join(t["text"] for t in r["turns"])
        lines = [x for x in said.split("\n") if x.strip()]
        whole = observed(texts[r["doc_id"]])
        assert len(lines) == len(whole)
        assert all(x in (w.line, w.content) for x, w in zip(lines, whole))
        assert r["rendered"] == render([(t["role"], t["text"]) for t in r["turns"]])
        assert r["n_lines"] == sum(t["text"].count("\n") + 1 for t in r["turns"])
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")
    assert {(r["n_lines"], r["roles"], r["rendered"])
            for r in format_chats(blank, model).collect()} == {(0, "", "")}

import random
from functools import cache

from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import ROWS, empty, sample, small

from tidemark.llm.token_counts import KEPT, Counter, Vocabulary, piece_vocabulary, token_counts


def tokenizer(vocabulary):
    """The tokenizers library's unigram model over the same pieces."""
    from tokenizers import Tokenizer, models, normalizers

    pieces = [("<unk>", 0.0), *vocabulary.pieces.items()]
    lowest = min(vocabulary.pieces.values())
    pieces[0] = ("<unk>", lowest)
    if vocabulary.by_bytes:
        pieces += [(f"<0x{b:02X}>", lowest) for b in range(256)]
    made = Tokenizer(models.Unigram(pieces, 0, vocabulary.by_bytes))
    made.normalizer = normalizers.Sequence(
        [normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")]
    )
    return made


def test_against_the_tokenizers_library(spark):
    vocabulary = piece_vocabulary()
    assert vocabulary.parts is not None and vocabulary.by_bytes
    reference, counter = tokenizer(vocabulary), Counter(vocabulary)
    texts = [r[0] for r in sample(spark).select("text").collect()]
    texts += [r[1] or "" for r in ROWS] + ["  a   b ", "\n\n", "梦 x \u0000ሴ"]
    for text in texts:
        assert counter.count(text)[0] == len(reference.encode(text, add_special_tokens=False).ids)


@cache
def brute(text, pieces, unknown):
    """All segmentations: the best score, and of equals the longest last piece, then on."""
    if not text:
        return 0, 0.0
    best, options = None, []
    for length in range(len(text), 0, -1):
        piece = text[-length:]
        if piece in dict(pieces):
            options.append((length, dict(pieces)[piece]))
    if text[-1] not in dict(pieces):
        options.append((1, unknown))
    for length, score in options:
        count, before = brute(text[:-length], pieces, unknown)
        if best is None or before + score > best[1]:
            best = (count + 1, before + score)
    return best


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.text("abc▁", min_size=1, max_size=9))
def test_against_all_segmentations(seed, text):
    rng = random.Random(seed)
    pieces = {"".join(rng.choices("ab▁", k=rng.randint(1, 4))): -float(rng.randint(1, 4))
              for _ in range(7)}
    # Without bytes, unknown characters in a row are one token; here each stands alone.
    text = text.replace("cc", "c")
    counter = Counter(Vocabulary(pieces, False))
    found = counter.best(text)
    want = brute(text, tuple(pieces.items()), counter.unknown)
    assert found[1] == want[1]
    if not any(c not in pieces for c in text):
        assert found[0] == want[0]
    reference = tokenizer(Vocabulary(pieces, False))
    reference.normalizer = None
    assert found[0] == len(reference.encode(text, add_special_tokens=False).ids)


def test_parts_give_what_the_whole_text_gives(spark):
    vocabulary = piece_vocabulary()
    apart, whole = Counter(vocabulary), Counter(vocabulary)
    whole.parts = None
    for row in sample(spark).select("text").limit(40).collect():
        assert apart.count(row[0]) == whole.count(row[0])
    for text in ("\n", "a\n\n b", "  \n x", "a b\n"):
        assert apart.count(text) == whole.count(text)
    long = " ".join(f"longer{i}" for i in range(9000)) * 2
    assert len(long) > 10 * KEPT and apart.count(long) == whole.count(long)
    fractions = {p: s - 0.25 for p, s in vocabulary.pieces.items()}
    assert Vocabulary(fractions, True).parts is None
    assert Vocabulary({"a": -1.0, "a▁b": -2.0, "▁": -1.0}, True).parts is None


def test_small_rows(spark):
    counter = Counter(piece_vocabulary())
    got = {(r["doc_id"], r["n_tokens"]) for r in token_counts(small(spark)).collect()}
    assert got == {(r[0], counter.count(r[1])[0]) for r in ROWS}
    assert {n for d, n in got if d in (3, 4)} == {0}
    assert token_counts(empty(spark)).collect() == []

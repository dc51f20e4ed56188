"""Token counts of a unigram vocabulary by a Viterbi pass that keeps scores and counts only."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import restored, texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MEMO = 1 << 18
LONGEST_KEPT = 48
KEPT = 1 << 14
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_WORDS_AND_BREAKS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with log scores; ``by_bytes``: an unknown character counts its UTF-8 bytes."""

    pieces: dict[str, float]
    by_bytes: bool

    @property
    def parts(self) -> re.Pattern | None:
        """What cuts a text where no piece reaches over, if sums of scores are then the same.

        No piece may go on after a space that follows other characters. Sums of whole numbers
        are exact in any order; other scores could round differently, and so decide ties. A line
        break that is in no piece is unknown in any segmentation.
        """
        whole = all(float(s).is_integer() for s in self.pieces.values())
        if not whole or any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            return None
        breaks = self.by_bytes and not any("\n" in p for p in self.pieces)
        return _WORDS_AND_BREAKS if breaks else _WORDS


def piece_vocabulary(path: str | None = None) -> Vocabulary:
    """The pieces and scores of a public sentencepiece file, read on the driver (bounded)."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=path or public_tokenizers.path("piece_bpe_32k.model")
    )
    ids = range(model.get_piece_size())
    return Vocabulary({
        model.id_to_piece(i): model.get_score(i) for i in ids
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                or model.is_unused(i))
    }, any(model.is_byte(i) for i in ids))


class Counter:
    """Counts pieces of the best segmentation, as the unigram tokenizers do.

    Scores are added in double precision. A later candidate replaces one only if its score is
    larger, and candidates that end at one place come longest first, so ties go to the longest
    last piece. A character that is no piece by itself may be taken as unknown, at the smallest
    score less a penalty; without bytes, unknown characters in a row count as one.

    Spaces become a sign that starts words, and a text that is not empty gets one in front.
    Where no piece reaches over a word's start and scores are whole numbers, words are segmented
    apart, and those seen before come from a memo of bounded size: same result, less time.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.by_bytes, self.parts = vocabulary.by_bytes, vocabulary.parts
        scores = vocabulary.pieces
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.matches = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.longest = max(map(len, scores), default=1)
        self.memo: dict[str, tuple[int, float]] = {}

    def count(self, text: str | None) -> tuple[int, float]:
        """Number of pieces and their score."""
        if not text:
            return 0, 0.0
        marked = SPACE + text.replace(" ", SPACE)
        if self.parts is None:
            return self.best(marked)
        total, score, memo = 0, 0.0, self.memo
        for part in self.parts.findall(marked):
            found = memo.get(part)
            if found is None:
                found = self.best(part)
                if len(part) <= LONGEST_KEPT:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[part] = found
            total += found[0]
            score += found[1]
        return total, score

    def best(self, text: str) -> tuple[int, float]:
        """Goes through the matches by their end; holds at most KEPT places before it."""
        single, unknown, longest = self.single, self.unknown, self.longest
        scores, counts, odd = [0.0], [0], [False]
        base, at, top, pieces, is_odd = 0, 0, None, 0, False
        matches = self.matches.iter(text) if len(self.matches) else ()
        for last, (length, gain) in chain(matches, ((len(text), (0, 0.0)),)):
            while at < last:
                char = text[at]
                if char not in single:
                    score = scores[at - base] + unknown
                    if top is None or score > top:
                        top, is_odd = score, True
                        if self.by_bytes:
                            more = len(char.encode())
                        else:
                            more = 0 if odd[at - base] else 1
                        pieces = counts[at - base] + more
                scores.append(top)
                counts.append(pieces)
                odd.append(is_odd)
                at, top = at + 1, None
                if at - base > KEPT + longest:
                    del scores[:KEPT], counts[:KEPT], odd[:KEPT]
                    base += KEPT
            if length:
                start = at + 1 - length - base
                score = scores[start] + gain
                if top is None or score > top:
                    top, pieces, is_odd = score, counts[start] + 1, False
        return counts[-1], scores[-1]


def token_counts(
    docs: DataFrame, vocabulary: Vocabulary | None = None, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, carried columns, n_tokens and score (the best segmentation's log score).

    A null or empty text has 0 tokens and score 0. Beside a text itself, memory is bounded. The vocabulary is broadcast. An empty table gives no rows.
    """
    rows = texts(docs, *carry)
    words = vocabulary or piece_vocabulary()
    shared = rows.sparkSession.sparkContext.broadcast((words.pieces, words.by_bytes))

    def count(batches):
        counter = Counter(Vocabulary(*shared.value))
        for batch in batches:
            found = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield batch.drop_columns(["text"]).append_column(
                "n_tokens", pa.array([f[0] for f in found], pa.int64())
            ).append_column("score", pa.array([f[1] for f in found], pa.float64()))

    kinds = "".join(
        f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text"
    )
    return restored(rows.mapInArrow(count, f"{kinds}n_tokens long, score double"), carry)

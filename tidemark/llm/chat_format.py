"""Transcripts to canonical turns: a hidden Markov model over lines recovers who speaks."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import restored, take, texts, written

ROLES = ("system", "user", "assistant", "other")
STATES = 2 * len(ROLES)  # of each role, the first line of a turn (even) and a later one (odd)
LENGTHS = 8
SAMPLE = 2000
CHUNK_TURNS = 512
SMOOTHING = 0.1
PRIOR = 20

# Names that transcripts use for a speaker, and the role each stands for.
SPEAKERS = {
    "system": 0, "user": 1, "human": 1, "assistant": 2, "ai": 2, "tool": 3, "function": 3,
}
# Names that are also ordinary first words of a line.
WORDS = {
    "instructions": 0, "context": 0, "question": 1, "customer": 1, "q": 1, "bot": 2, "answer": 2,
    "agent": 2, "model": 2, "a": 2,
}
_MARKER = re.compile(
    r"^\s*(?:#{1,6}\s*|\*\*|\[|<\|?)?(" + "|".join([*SPEAKERS, *WORDS])
    + r")(?:\*\*|\]|\|?>)?\s*[:>](?:\*\*)?\s*", re.IGNORECASE,
)


@dataclass(frozen=True)
class Line:
    """A line that is not blank: what it shows of its speaker, and its text.

    ``marker`` is 0 for none, 1 to 4 for a name of SPEAKERS by role, 5 to 8 for one of WORDS.
    ``blanks`` are the blank lines before it, ``content`` is the line without its marker.
    """

    marker: int
    blanks: tuple[str, ...]
    length: int
    line: str
    content: str

    @property
    def symbol(self) -> tuple[int, int, int]:
        return self.marker, int(bool(self.blanks)), self.length

    def names(self, role: int) -> bool:
        return self.marker > 0 and (self.marker - 1) % len(ROLES) == role


def observed(text: str | None) -> list[Line]:
    """The lines of a text that are not blank; its beginning counts as a blank line."""
    found, blanks = [], [""]
    for line in (text or "").split("\n"):
        if not line.strip():
            blanks.append(line)
            continue
        marker = _MARKER.match(line)
        name = marker[1].lower() if marker else ""
        code = 1 + SPEAKERS[name] if name in SPEAKERS else 0
        if name in WORDS:
            code = 1 + len(ROLES) + WORDS[name]
        content = line[marker.end():] if marker else line
        length = min(LENGTHS - 1, len(content).bit_length() // 2)
        found.append(Line(code, tuple(blanks), length, line, content))
        blanks = []
    return found


MARKERS = 1 + 2 * len(ROLES)


def _marker_prior() -> np.ndarray:
    """What a state shows of a marker before any is counted: a name begins its own role's turns.

    An ordinary word may also begin a line inside a turn.
    """
    prior = np.zeros((STATES, MARKERS))
    for state in range(STATES):
        role, first = state // 2, state % 2 == 0
        prior[state, 1:1 + len(ROLES)] = 0.01 if first else 0.002
        prior[state, 1 + len(ROLES):] = 0.001 if first else 0.006
        if first:
            prior[state, [1 + role, 1 + len(ROLES) + role]] = 0.5, 0.05
        prior[state, 0] = 1 - prior[state].sum()
    return prior


@dataclass
class Speakers:
    """Log probabilities: of the first state, of the next state, and, in a state, of a marker, of
    a blank line before, and of a length. A line shows the three independently."""

    start: np.ndarray
    step: np.ndarray
    marker: np.ndarray
    blank: np.ndarray
    length: np.ndarray

    def emitted(self, symbol: tuple[int, int, int]) -> np.ndarray:
        marker, blank, length = symbol
        return self.marker[:, marker] + self.blank[:, blank] + self.length[:, length]

    def states(self, symbols: list[tuple[int, int, int]]) -> list[int]:
        """The most probable states (Viterbi); of equals the lower state, from the end on."""
        if not symbols:
            return []
        score, back = self.start + self.emitted(symbols[0]), []
        for symbol in symbols[1:]:
            ways = score[:, None] + self.step
            best = ways.argmax(axis=0)
            back.append(best.astype(np.int8))
            score = ways[best, np.arange(STATES)] + self.emitted(symbol)
        path = [int(score.argmax())]
        for best in reversed(back):
            path.append(int(best[path[-1]]))
        return path[::-1]

    def turns(self, text: str | None) -> list[tuple[str, str]]:
        """Role and text of each turn; neighbouring turns of one role stay apart.

        A marker goes only where a turn of the role it names begins. Blank lines inside a turn
        stay; those before a turn and at the end are separators.
        """
        lines = observed(text)
        out: list[tuple[int, list[str]]] = []
        for state, line in zip(self.states([x.symbol for x in lines]), lines):
            role, first = state // 2, state % 2 == 0
            if first or not out or out[-1][0] != role:
                out.append((role, [line.content if first and line.names(role) else line.line]))
            else:
                out[-1][1].extend([*line.blanks, line.line])
        return [(ROLES[role], "\n".join(content)) for role, content in out]


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)


def transcripts(conversations: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """conv_id, chunk, turns (role, text) in order, and the transcript they make.

    Speakers are marked in four ways, by a hash of conversation and turn: two kinds of name and
    colon, a heading, or a blank line alone. Turns are ordered by number (null last), role and
    text; a null text is empty, and a role that is null or not of ROLES is "other". Repeated rows
    are turns of their own. Rows without a conv_id are one conversation. Every ``chunk_turns``
    turns of a conversation are a transcript of their own, so none is unbounded; a model reads each
    afresh.
    """
    rows = take(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.when(F.col("role").isin(*ROLES[:-1]), F.col("role")).otherwise(ROLES[-1]).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    way = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))
    plain = F.when(F.col("role") == ROLES[-1], "Tool").otherwise(F.initcap("role"))
    other = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI")
    marked = F.concat(
        F.when(way == 0, F.concat(plain, F.lit(": ")))
        .when(way == 1, F.concat(F.lit("**"), other.otherwise(plain), F.lit("**: ")))
        .when(way == 2, F.concat(F.lit("### "), plain, F.lit(": ")))
        .otherwise(F.lit("\n")), "text",
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    said = rows.withColumn("at", F.row_number().over(order) - 1).select(
        "conv_id", F.floor(F.col("at") / chunk_turns).alias("chunk"),
        F.struct("at", "role", "text", marked.alias("marked")).alias("said"),
    )
    return said.groupBy("conv_id", "chunk").agg(
        F.sort_array(F.collect_list("said")).alias("said")
    ).select(
        "conv_id", "chunk",
        F.transform("said", lambda s: F.struct(s["role"].alias("role"), s["text"].alias("text")))
        .alias("turns"),
        F.array_join(F.transform("said", lambda s: s["marked"]), "\n").alias("text"),
    )


def fit(examples: DataFrame, sample: int = SAMPLE) -> Speakers:
    """Counts states and what they show in at most ``sample`` transcripts with known turns.

    The sample is the transcripts with the smallest hash of conv_id among those whose
    crc32(conv_id as text) leaves no remainder of 1 by 3. Counts are summed in Spark. What a line
    shows is counted apart: markers are smoothed towards what a name means, the rest towards even.
    Words that may also begin a line keep the share they have before counting.
    """
    chosen = examples.filter("crc32(CAST(conv_id AS STRING)) % 3 != 1").orderBy(
        F.xxhash64("conv_id"), "conv_id", "chunk"
    ).limit(sample)

    def count(batches):
        for batch in batches:
            out = []
            for turns, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                states = [
                    2 * ROLES.index(t["role"]) + (i > 0) for t in turns
                    for i in range(len(observed(t["text"])))
                ]
                symbols = [line.symbol for line in observed(text)]
                if len(states) != len(symbols):
                    continue  # a turn without text, of which only the marker is a line
                out += [(0, 0, s) for s in states[:1]]
                out += [(1, a, b) for a, b in zip(states, states[1:])]
                out += [(2 + i, a, b[i]) for a, b in zip(states, symbols) for i in range(3)]
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.record_batch(
                [pa.array(c, pa.int32()) for c in columns], names=["kind", "a", "b"]
            )

    counted = chosen.select("turns", "text").mapInArrow(count, "kind int, a int, b int")
    prior = _marker_prior()
    tables = [
        np.full((1, STATES), SMOOTHING), np.full((STATES, STATES), SMOOTHING), PRIOR * prior,
        np.full((STATES, 2), PRIOR / 2), np.full((STATES, LENGTHS), PRIOR / LENGTHS),
    ]
    for row in counted.groupBy("kind", "a", "b").count().collect():  # at most a few hundred
        tables[row["kind"]][row["a"], row["b"]] += row["count"]
    words = np.s_[:, 1 + len(ROLES):]
    tables[2][words] = 0
    start, step, marker, blank, length = (x / x.sum(axis=1, keepdims=True) for x in tables)
    marker = marker * (1 - prior[words].sum(axis=1, keepdims=True))
    marker[words] = prior[words]
    return Speakers(*(np.log(x) for x in (start[0], step, marker, blank, length)))


def format_chats(
    docs: DataFrame, model: Speakers, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Per row: doc_id, carried columns, n_lines, roles (comma-separated), turns and rendered.

    ``docs`` has doc_id and text, one transcript each. Markers that begin a turn and blank lines
    between turns go, all other text stays; n_lines counts the lines of all turns. A null, empty or
    blank text has no turns and renders as an empty text. A transcript is one task's; its memory
    is eight states a line. An empty table gives no rows.
    """
    rows = texts(docs, *carry)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.start, model.step, model.marker, model.blank, model.length)
    )

    def parse(batches):
        speakers = Speakers(*shared.value)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                turns = speakers.turns(text)
                out.append({
                    "n_lines": sum(t[1].count("\n") + 1 for t in turns),
                    "roles": ",".join(role for role, _ in turns),
                    "turns": [{"role": r, "text": t} for r, t in turns],
                    "rendered": render(turns),
                })
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            made = batch.drop_columns(["text"])
            for name, of in (("n_lines", pa.int64()), ("roles", pa.string()), ("turns", kind),
                             ("rendered", pa.string())):
                made = made.append_column(name, pa.array([o[name] for o in out], of))
            yield made

    kinds = "".join(
        f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text"
    )
    return restored(rows.mapInArrow(
        parse,
        f"{kinds}n_lines long, roles string, turns array<struct<role: string, text: string>>, "
        "rendered string",
    ), carry)


def recovered(conversations: DataFrame) -> DataFrame:
    """Transcripts of all conversations, parsed by a model learnt from some, beside the truth.

    conv_id, chunk, n_lines, roles, true_roles, rendered.
    """
    made = written(transcripts(conversations), "transcripts")
    model = fit(made)
    named = made.select(
        F.col("conv_id").alias("doc_id"), "text", "chunk",
        F.array_join(F.transform("turns", lambda t: t["role"]), ",").alias("true_roles"),
    )
    return format_chats(named, model, carry=("chunk", "true_roles")).select(
        F.col("doc_id").alias("conv_id"), "chunk", "n_lines", "roles", "true_roles", "rendered"
    )

import math
import re
from collections import Counter

from helpers import SF_DIR, sample

from tidemark.llm.license_scan import (
    ALL,
    LICENSE_FILE,
    NARROW,
    TEMPLATES,
    _least,
    anchors,
    document_files,
    key_pairs,
    license_scan,
    weights,
)
from tidemark.llm.license_texts import FULL
from tidemark.llm.queries import op6_license_scan

from test_license_texts import CASES


def words(text):
    return re.findall(r"[a-z0-9]+", text.lower())


class Plain:
    """Every part and window of every text against every template, one after the other."""

    def __init__(self, files):
        texts = [set(words(text or "")) for _, text in files]
        self.df = Counter(t for text in texts for t in text)
        self.df.update(t for _, text in ALL for t in set(words(text)))
        self.total = len(texts) + len(ALL)
        self.templates = [self.weighed(words(text)) for _, text in ALL]
        self.by_size = {}
        for t, (_, text) in enumerate(ALL):
            self.by_size.setdefault(len(words(text)), []).append(t)
        self.pairs = {}
        for v, (_, text) in zip(self.templates, ALL):
            for at, pair in key_pairs(text, v, 0.8):
                self.pairs.setdefault(pair, set()).add((len(words(text)), at))

    def weighed(self, found):
        raw = {t: n * (math.log((1 + self.total) / (1 + self.df[t])) + 1)
               for t, n in Counter(found).items()}
        length = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / length for t, x in raw.items()}

    def units(self, text):
        lines, blocks = text.split("\n"), re.split("\n[^a-z0-9\n]*\n", text.lower())
        for i, part in enumerate([text, *lines]):
            yield i, words(part), range(len(ALL))
        for i, part in enumerate(blocks):
            yield i + (1 << 32), words(part), range(len(ALL))
        own = words(text)
        for size, start in sorted({
            (size, max(pos - at, 0)) for pos, pair in enumerate(zip(own, own[1:]))
            for size, at in self.pairs.get(" ".join(pair), ())
        }):
            yield start * 1024 + size + (1 << 45), own[start:start + size], self.by_size[size]

    def own(self, text):
        best = None
        for unit, found, templates in self.units(text or ""):
            vector = self.weighed(found)
            for t in templates:
                near = self.templates[t]
                score = round(sum(x * near.get(term, 0) for term, x in vector.items()), 6)
                rank = (ALL[t] in FULL, score, unit == 0, -t, -unit)
                if score >= 0.8 and (best is None or rank > best):
                    best = rank
        return best and (ALL[-best[3]][0], best[1], "file" if best[2] else "header")


def expected(files):
    """Every part against every template; then up the path, directory by directory."""
    plain, known = Plain(files), {}
    for _, text in files:
        if text not in known:
            known[text] = plain.own(text)
    mine = [known[text] for _, text in files]
    held = {}
    for (path, _), found in zip(files, mine):
        if path and found and re.match(LICENSE_FILE, path.rsplit("/", 1)[-1]):
            folder = path.rpartition("/")[0]
            held[folder] = min(held.get(folder, (9,)), (-found[1], path, found[0]))
    out = []
    for (path, _), found in zip(files, mine):
        if found:
            out.append((path, *found, path))
            continue
        folder = None if path is None else path.rpartition("/")[0]
        while folder is not None and folder not in held:
            folder = folder.rpartition("/")[0] if folder else None
        out.append((path, None, None, None, None) if folder is None else
                   (path, held[folder][2], -held[folder][0], "inherited", held[folder][1]))
    return out


FILES = [
    ("a/LICENSE", "Released under the MIT License."),
    ("a/b/c.py", "code\ncode"),
    ("a/b/d.py", "# Licensed under the Apache License, Version 2.0.\ncode and more code"),
    ("a/e/COPYING.txt", TEMPLATES[6][1] + "\n\n" + "other words " * 30),
    ("a/e/f/g", None),
    ("a/e/LICENSE", "no licence at all"),
    ("h/i.py", "permission is hereby given to nobody, free of use"),
    ("h/license", ""),
    ("top", "x"),
    (None, "Licensed under CC BY-NC 4.0.\nwords"),
    (None, "words"),
    ("a/b/c.py", "code\ncode"),
    ("a/b/d.py", "another text of the same path"),
]


def check(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_against_every_part_and_template(spark):
    df = spark.createDataFrame(FILES, "path string, text string")
    clash = df.selectExpr("*", "'x' AS folder", "'x' AS license", "'x' AS PATH", "1 AS unit")
    check(license_scan(clash).collect(), expected(FILES))
    rooted = [*FILES, ("LICENSE", "Licensed under CC BY-NC 4.0.")]
    check(license_scan(spark.createDataFrame(rooted, "path string, text string")).collect(),
          expected(rooted))


def test_documents(spark):
    files = [(r["path"], r["text"]) for r in document_files(sample(spark)).collect()]
    want = expected(files)
    check(op6_license_scan(spark, SF_DIR).collect(), want)
    assert sum(w[1] is not None for w in want) >= 3


def test_empty(spark):
    assert license_scan(spark.createDataFrame([], "path string, text string")).collect() == []


def test_licence_texts_against_every_part_and_template(spark):
    files = [(f"d{i}/LICENSE", text) for i, (text, _) in enumerate(CASES)]
    check(license_scan(spark.createDataFrame(files, "path string, text string")).collect(),
          expected(files))


def test_words_in_many_files_weigh_less(spark):
    """A licence line within a phrase that all files hold is found; the phrase alone is none."""
    phrase = "acme widgets toolkit"
    line = f"{phrase} released under the MIT license"
    rows = [("a", line)] + [(f"b{i}", f"{phrase} {i}") for i in range(400)]
    found = {r["path"]: r["license"] for r in license_scan(
        spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found["a"] == "MIT" and set(found.values()) == {"MIT", None}
    check(license_scan(spark.createDataFrame(rows, "path string, text string")).collect(),
          expected(rows))


def test_long_text_of_one_key_word(spark):
    """A key word alone lies on no template: only where its neighbour agrees is a window cut."""
    text = " ".join("licensed" if i % 10 == 0 else f"w{i % 97}" for i in range(100_000))
    rows = [("a", text), ("b", text + "\nReleased under the MIT License.")]
    found = license_scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r["path"]: r["license"] for r in found} == {"a": None, "b": "MIT"}


def test_ties_and_repeats(spark):
    """Of equal scores the first template counts; repeated rows are counted and stay."""
    both = "Released under the MIT License.\nLicensed under CC BY-NC 4.0."
    rows = [("x", both)] * 3 + [("y", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.")]
    check(license_scan(spark.createDataFrame(rows, "path string, text string")).collect(),
          expected(rows))


def test_anchor_words_are_needed():
    """Without the anchor words, what is left of a template stays below the threshold."""
    _, vectors = weights()
    held = set(anchors(vectors, 0.8))
    for v in vectors:
        assert sum(w * w for t, w in v.items() if t not in held) < 0.64


def test_too_few_shared_words_cannot_reach_the_threshold():
    _, vectors = weights(ALL)
    assert any(len(words(text)) > NARROW for _, text in ALL)
    for v in vectors:
        parts = sorted((w * w for w in v.values()), reverse=True)
        assert sum(parts[:_least(v, 0.8) - 1]) < 0.64


def test_plan_has_no_python(spark):
    plan = op6_license_scan(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

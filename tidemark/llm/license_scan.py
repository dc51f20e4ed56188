"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance."""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import take, written
from tidemark.llm.license_texts import FULL, KEYS, SHORT

THRESHOLD = 0.8
NARROW = 32
LICENSE_FILE = r"(?i)^(licen[cs]e|copying)([.-].*)?$"

# Notices of public licences, as their publishers word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction"),
)



def _words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


# All templates: of those with the same words the first counts.
ALL = {}
for _template in (*TEMPLATES, *SHORT, *FULL):
    ALL.setdefault(tuple(_words(_template[1])), _template)
ALL = tuple(ALL.values())

# Frequent words (English, and German "mit"), which make poor anchors.
FREQUENT = frozenset(
    "a an and any are as at be by can do for free from had has have if in is it may mit more not of on "
    "one or other so that the their then there this to under up use was will with without you "
    "your".split()
)


def terms(text: str) -> Counter:
    return Counter(_words(text))


def weights(templates=TEMPLATES, files: int = 0, found: dict[str, int] | None = None):
    """Inverse document frequencies of the templates' words, and the templates as unit vectors.

    Documents are the templates and the ``files``, of which ``found`` counts those with a word.
    """
    counts = [terms(text) for _, text in templates]
    seen = Counter(term for c in counts for term in c)
    total = len(counts) + files
    idf = {t: math.log((1 + total) / (1 + n + (found or {}).get(t, 0))) + 1
           for t, n in seen.items()}
    vectors = []
    for count in counts:
        raw = {t: n * idf[t] for t, n in count.items()}
        length = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / length for t, w in raw.items()})
    return idf, vectors


def anchors(vectors, threshold: float) -> list[str]:
    """Terms of which a text must hold one to come near any template.

    The cosine is at most the length of the template's part that the text shares. So if the terms
    left, when some are taken away, make a part shorter than the threshold, they cannot reach it
    alone. Taken are the heaviest, frequent words and numbers last: few texts should hold one.
    """
    found = set()
    for vector in vectors:
        poor = {t for t in vector if t in FREQUENT or t.isdigit()}
        found |= _taken(vector, sorted(vector, key=lambda t: (t in poor, -vector[t], t)), threshold)
    return sorted(found)


def _taken(vector, terms, threshold: float) -> set[str]:
    found, left = set(), 1.0
    for term in terms:
        if left < threshold * threshold - 1e-9:
            break
        found.add(term)
        left -= vector[term] ** 2
    return found


def _least(vector, threshold: float) -> int:
    """How many terms a text must share at least: of the heaviest, enough for the threshold."""
    shared, parts = 0.0, sorted((w * w for w in vector.values()), reverse=True)
    for n, part in enumerate(parts, 1):
        shared += part
        if shared >= threshold * threshold - 1e-9:
            return n
    return len(parts)


def key_words(vector, threshold: float) -> set[str]:
    """KEYS, the heaviest first, without which a text cannot come near, or all that there are.

    A text with none of them names no licence, whatever it shares.
    """
    return _taken(vector, sorted(KEYS & vector.keys(), key=lambda t: (-vector[t], t)), threshold)


def key_pairs(template: str, vector, threshold: float) -> list[tuple[int, str]]:
    """Where two neighbouring words of a template, one of them a key word, stand, and the two."""
    words, keys = _words(template), key_words(vector, threshold)
    return [(at, f"{a} {b}") for at, (a, b) in enumerate(zip(words, words[1:]))
            if a in keys or b in keys]


def license_scan(
    files: DataFrame, threshold: float = THRESHOLD, templates=ALL,
) -> DataFrame:
    """Per row: path, license, score, found ('file', 'header', 'inherited' or null), from_path.

    ``files`` has path and text. Whole texts, lines, paragraphs (between lines without words)
    and, for each template, windows of as many words as it has (over line ends, without comment
    signs) are compared with the templates as vectors of lower-cased words weighted by frequency
    times inverse document frequency; a file's own licence is the one of the largest cosine
    (rounded to six digits) from ``threshold`` on: templates of FULL before others, as a licence's
    first sentence may be that of several; of equals the whole text before parts, then the first
    template, then the first part. A file without one inherits from the nearest directory above it
    that holds a licence file (by its name) with a licence of its own; of several the largest score, then the smallest path.

    Document frequencies are counted over all rows of ``files``, and the templates as one document
    each, so that a licence's own words weigh more than those of all licences in few files too.
    A window lies where two neighbouring words, one of them a key word, are those of a template of
    its length at the same place; templates of one word have no windows.

    Only parts and texts that hold an anchor word are cut into words; no other can reach the
    threshold. Inheritance is solved for directories, a row each, before files join them, so a
    directory with most files costs rows of one join that Spark can split. A null path keeps its
    own licence and inherits nothing; a path without a slash lies in the root directory. A null
    text has no licence. Repeated rows stay. An empty table gives no rows.
    """
    plain = take(files, "path", "text")
    lowered = plain.select(
        F.col("path"), F.lower(F.coalesce("text", F.lit(""))).alias("text"),
    )
    frequencies = written(lowered.select(F.explode(F.array_distinct(
        F.regexp_extract_all("text", F.lit("[a-z0-9]+"), 0))).alias("term"),
    ).groupBy("term").agg(F.count("*").alias("n")), "license-words")
    total = plain.count()
    known = sorted(weights(templates)[0])
    counted = frequencies.filter(F.col("term").isin(known)).collect()
    idf, vectors = weights(templates, total, {r["term"]: r["n"] for r in counted})
    needed = set(anchors(
        [v for v, template in zip(vectors, templates) if template in TEMPLATES], threshold,
    )).union(*[key_words(v, threshold) or anchors([v], threshold) for v in vectors])
    hold = "(^|[^a-z0-9])(" + "|".join(sorted(needed)) + ")([^a-z0-9]|$)"
    rare = frequencies.select(
        "term", (F.log(F.lit(1.0 + total + len(templates)) / (1 + F.col("n"))) + 1).alias("idf"))
    slash = F.length("path") - F.length(F.substring_index("path", "/", -1)) - 1
    folder = F.when(slash > 0, F.expr("left(path, cast(length(path) - "
                                      "length(substring_index(path, '/', -1)) - 1 as int))"))
    own = _own(
        lowered.filter(F.col("text").rlike(hold)), hold, templates, threshold, idf, vectors, rare)
    named = F.element_at(_constant("array<string>", [n for n, _ in templates]), F.col("template"))
    own = written(own.withColumn("license", named), "licenses")
    keyed = plain.select("path", F.xxhash64(
        F.lower(F.coalesce("text", F.lit("")))).alias("text_key"), F.coalesce(folder, F.lit(""))
        .alias("folder"))
    marked = keyed.join(
        own, keyed["path"].eqNullSafe(own["own_path"]) & (keyed["text_key"] == own["own_key"]),
        "left",
    ).select("path", "folder", "license", "score", "whole")
    held = own.filter(F.substring_index("own_path", "/", -1).rlike(LICENSE_FILE)).withColumn(
        "path", F.col("own_path")
    ).withColumn("above", F.coalesce(folder, F.lit("")))
    given = held.groupBy("above").agg(F.min(F.struct(
        (-F.col("score")).alias("s"), "path", "license", "score"
    )).alias("given"))
    folders = keyed.filter("path IS NOT NULL").select("folder").distinct()
    names = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.concat(
        F.array(F.struct(F.lit("").alias("above"), F.lit(0).alias("depth"))),
        F.transform(
            F.sequence(F.lit(1), F.size(names)),
            lambda i: F.struct(
                F.array_join(F.slice(names, F.lit(1), i), "/").alias("above"), i.alias("depth")
            ),
        ),
    )).alias("up")).select("folder", "up.*")
    nearest = above.join(given, "above").groupBy("folder").agg(
        F.max_by("given", "depth").alias("given")
    )
    joined = marked.join(nearest.withColumnRenamed("folder", "in_folder"),
                         (F.col("folder") == F.col("in_folder")) & F.col("path").isNotNull(), "left")
    has, gets = F.col("license").isNotNull(), F.col("given").isNotNull()
    return joined.select(
        "path",
        F.coalesce("license", "given.license").alias("license"),
        F.coalesce("score", "given.score").alias("score"),
        F.when(has & F.col("whole"), "file").when(has, "header").when(gets, "inherited")
        .alias("found"),
        F.when(has, F.col("path")).otherwise(F.col("given.path")).alias("from_path"),
    )


def _constant(kind: str, value):
    return F.from_json(F.lit(json.dumps(value)), kind)


def _small(spark, kind: str, rows):
    """Rows made from the templates, bounded by them, as a table: plans stay small."""
    made = spark.range(1).select(F.inline(_constant(f"array<struct<{kind}>>", rows)))
    return F.broadcast(written(made, "templates"))


def _own(texts, hold, templates, threshold, idf, vectors, rare):
    """own_path, own_key, template (from 1), score, whole: the best of a file's parts and text."""
    spark, lengths = texts.sparkSession, [len(_words(text)) for _, text in templates]
    base = written(
        texts.select("path", F.xxhash64("text").alias("key"), "text").distinct()
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("words", F.regexp_extract_all("text", F.lit("[a-z0-9]+"), 0)), "license-texts",
    )
    units = written(_units(base, hold, templates, vectors, threshold), "license-units")
    held = {}
    for t, vector in enumerate(vectors):
        for term, w in vector.items():
            for size in (0, lengths[t]):
                held.setdefault((term, size), []).append({"t": t, "w": w})
    postings = _small(
        spark, "term string, size int, held array<struct<t int, w double>>",
        [{"term": term, "size": size, "held": found}
         for (term, size), found in sorted(held.items())])
    known = _small(spark, "term string, idf double",
                   [{"term": term, "idf": w} for term, w in sorted(idf.items())])

    def frequent(units):
        return units.repartition("id", "unit").select(
            "id", "unit", "size", F.explode("words").alias("term"),
        ).groupBy("id", "unit", "size", "term").agg(F.count("*").alias("tf"))

    # First with words of templates alone: the cosine can only fall by the others.
    weighed = frequent(units).join(known, "term").join(
        postings, ["term", "size"], "left").withColumn("w", F.col("tf") * F.col("idf"))
    near = F.coalesce("held", _constant("array<struct<t int, w double>>", []))
    sums = weighed.select("id", "unit", F.inline(F.concat(
        F.array(F.struct(F.lit(-1).alias("t"), (F.col("w") * F.col("w")).alias("v"))),
        F.transform(near, lambda p: F.struct(p["t"].alias("t"), (F.col("w") * p["w"]).alias("v"))),
    ))).groupBy("id", "unit", "t").agg(F.sum("v").alias("v"))
    hopeful = written(sums.groupBy("id", "unit").agg(
        F.max(F.when(F.col("t") < 0, F.col("v"))).alias("square"),
        F.collect_list(F.when(F.col("t") >= 0, F.struct("t", "v"))).alias("dots"),
    ).withColumn("dots", F.filter(
        "dots", lambda d: d["v"] >= F.sqrt("square") * (threshold - 1e-6),
    )).filter(F.size("dots") > 0), "license-near")
    rest = frequent(units.join(hopeful.select("id", "unit"), ["id", "unit"], "left_semi")).join(
        known, "term", "left_anti").join(rare, "term").groupBy("id", "unit").agg(
        F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("more"))
    scored = hopeful.join(rest, ["id", "unit"], "left").withColumn(
        "length", F.sqrt(F.col("square") + F.coalesce("more", F.lit(0.0))))
    full = [t for t, template in enumerate(templates) if template in FULL]
    best = F.array_max(F.filter(
        F.transform("dots", lambda d: F.struct(
            d["t"].isin(full).alias("full"), F.round(d["v"] / F.col("length"), 6).alias("score"),
            (-1 - d["t"]).alias("minus"),
        )), lambda s: s["score"] >= threshold,
    ))
    top = scored.select("id", "unit", best.alias("best")).filter("best IS NOT NULL").groupBy(
        "id").agg(F.max(F.struct(
            "best.full", "best.score", (F.col("unit") == 0).alias("whole"), "best.minus",
            (-F.col("unit")).alias("first"),
        )).alias("top"))
    return base.select("id", "path", "key").join(top, "id").select(
        F.col("path").alias("own_path"), F.col("key").alias("own_key"),
        (-F.col("top.minus")).alias("template"), F.col("top.score").alias("score"),
        F.col("top.whole").alias("whole"),
    )


def _units(base, hold, templates, vectors, threshold):
    """id, unit, size, words: size is 0 for texts, lines and paragraphs, else a window's length.

    A wide window is left out if it shares fewer words with each template of its length than the
    heaviest of that template's that could reach the threshold.
    """
    spark = base.sparkSession
    base = base.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    lines, blocks = F.split("text", "\n"), F.split("text", "\n[^a-z0-9\n]*\n")
    parts = F.concat(
        F.array(F.struct(F.lit(0).cast("long").alias("unit"), F.col("text").alias("part"))),
        F.transform(lines, lambda line, i: F.struct(
            (i + 1).cast("long").alias("unit"), line.alias("part"))),
        F.transform(blocks, lambda block, i: F.struct(
            (i + F.lit(1 << 32)).alias("unit"), block.alias("part"))),
    )
    plain = base.select("id", F.inline(F.filter(parts, lambda p: p["part"].rlike(hold)))).select(
        "id", "unit", F.lit(0).alias("size"),
        F.regexp_extract_all("part", F.lit("[a-z0-9]+"), 0).alias("words"))
    places, wide = {}, {}
    for (_, text), vector in zip(templates, vectors):
        size = len(_words(text))
        for at, pair in key_pairs(text, vector, threshold):
            places.setdefault(pair, set()).add((size, at))
        if size > NARROW:
            wide.setdefault(size, []).append(
                {"terms": sorted(vector), "least": _least(vector, threshold)})
    table = _small(spark, "pair string, places array<struct<size int, shift int>>", [
        {"pair": pair, "places": [{"size": n, "shift": at} for n, at in sorted(found)]}
        for pair, found in sorted(places.items())])
    bounds = _small(
        spark, "size int, bounds array<struct<terms array<string>, least int>>",
        [{"size": n, "bounds": found} for n, found in sorted(wide.items())])
    pair = lambda i: F.concat(F.get("words", i), F.lit(" "), F.get("words", i + 1))
    starts = base.filter(F.size("words") > 1).select("id", F.inline(F.filter(F.transform(
        F.sequence(F.lit(0), F.size("words") - 2),
        lambda i: F.struct(i.alias("pos"), pair(i).alias("pair")),
    ), lambda at: at["pair"].isin(sorted(places)))))
    windows = (
        starts.join(table, "pair").select("id", "pos", F.inline("places"))
        .select("id", "size", F.greatest(F.col("pos") - F.col("shift"), F.lit(0)).alias("start"))
        .distinct()
        .join(base.select("id", "words"), "id")
        .select("id", "size", "start", F.slice("words", F.col("start") + 1, F.col("size"))
                .alias("words"))
        .join(bounds, "size", "left")
        .filter(F.col("bounds").isNull() | F.exists("bounds", lambda b: F.size(
            F.array_intersect("words", b["terms"])) >= b["least"]))
        .select("id", (F.col("start") * F.lit(1 << 10) + F.col("size") + F.lit(1 << 45))
                .alias("unit"), "size", "words")
    )
    return plain.unionAll(windows)


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: source / language / thousand / hundred / name.

    The documents have no file names, so each whole hundred's first one stands for that
    directory's LICENSE, and a whole thousand's first one for the LICENSE of the directory above.
    """
    doc = F.col("doc_id").cast("long")
    name = F.concat(doc.cast("string"), F.lit(".txt"))
    thousand, hundred = F.floor(doc / 1000).cast("string"), F.floor(doc / 100).cast("string")
    base = [F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))]
    return take(docs, "doc_id", "text", "source", "lang").select(
        "doc_id", "text",
        F.when(doc % 1000 == 0, F.concat_ws("/", *base, thousand, F.lit("LICENSE")))
        .when(doc % 100 == 0, F.concat_ws("/", *base, thousand, hundred, F.lit("LICENSE")))
        .when(doc.isNotNull(), F.concat_ws("/", *base, thousand, hundred, name)).alias("path"),
    )

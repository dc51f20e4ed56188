"""The registered queries of the package, over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    centroids,
    chat_format,
    embedding_dedup,
    license_scan,
    minhash,
    mixing,
    neighbours,
    packing,
    prefix_trie,
    quality,
    simhash_dedup,
    substring_dedup,
    token_counts,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id",
        "offset",
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.against_next(table(spark, sf_dir, "documents"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(
        license_scan.document_files(table(spark, sf_dir, "documents"))
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.recovered(table(spark, sf_dir, "conversations"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return quality.classify(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_pack, op2_token_counts, op3_minhash, op4_mix, op5_substring_dedup, op6_license_scan,
    op7_neighbours, op8_simhash, op9_chat_format, op10_quality, op11_embedding_dedup,
    op12_prefix_trie, op13_centroids,
)}

def _license_sql() -> str:
    """Whole texts and lines, the templates of one-line notices, words counted over all files."""
    tf = ", ".join(
        f"({i}, '{t}', {n})" for i, (_, text) in enumerate(license_scan.TEMPLATES)
        for t, n in sorted(license_scan.terms(text).items())
    )
    seen = Counter(t for _, text in license_scan.ALL for t in license_scan.terms(text))
    prior = ", ".join(f"('{t}', {n})" for t, n in sorted(seen.items()))
    names = ", ".join(f"({i}, '{n}')" for i, (n, _) in enumerate(license_scan.TEMPLATES))
    return f"""
WITH prior(term, n) AS (VALUES {prior}), template(t, term, n) AS (VALUES {tf}),
names(t, license) AS (VALUES {names}),
files AS (
    SELECT doc_id, lower(coalesce(text, '')) AS text,
        coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || (doc_id // 1000)
            || CASE WHEN doc_id % 1000 = 0 THEN '' ELSE '/' || (doc_id // 100) END AS folder,
        CASE WHEN doc_id % 100 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END AS name
    FROM documents
), df AS (
    SELECT term, sum(n) AS n FROM (
        SELECT term, n FROM prior UNION ALL
        SELECT unnest(list_distinct(regexp_extract_all(text, '[a-z0-9]+'))), 1 FROM files
    ) GROUP BY term
), idf AS (
    SELECT term, ln((1 + {len(license_scan.ALL)} + (SELECT count(*) FROM files)) / (1 + n)) + 1 AS idf
    FROM df
), postings AS (
    SELECT t, template.term, template.n * idf / sqrt(sum((template.n * idf) ** 2) OVER (PARTITION BY t)) AS weight
    FROM template JOIN idf ON template.term = idf.term
), lines AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM files),
units AS (
    SELECT doc_id, 0 AS unit, text AS part FROM files UNION ALL
    SELECT doc_id, generate_subscripts(parts, 1), unnest(parts) FROM lines
), words AS (
    SELECT doc_id, unit, unnest(regexp_extract_all(part, '[a-z0-9]+')) AS term FROM units
), tf AS (
    SELECT doc_id, unit, term, count(*) AS n FROM words GROUP BY ALL
), w AS (
    SELECT doc_id, unit, tf.term, n * idf AS w FROM tf JOIN idf ON tf.term = idf.term
), lengths AS (
    SELECT doc_id, unit, sqrt(sum(w * w)) AS length FROM w GROUP BY ALL
), scores AS (
    SELECT d.doc_id, d.unit, d.t, round(d.dot / l.length, 6) AS score FROM (
        SELECT doc_id, unit, t, sum(w * weight) AS dot
        FROM w JOIN postings p ON w.term = p.term GROUP BY ALL
    ) d JOIN lengths l ON d.doc_id = l.doc_id AND d.unit = l.unit
), own AS (
    SELECT * FROM scores WHERE score >= 0.8 QUALIFY
        row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, unit = 0 DESC, t, unit) = 1
), marked AS (
    SELECT f.folder, f.folder || '/' || f.name AS path, f.name, n.license, o.score, o.unit
    FROM files f LEFT JOIN own o ON f.doc_id = o.doc_id LEFT JOIN names n ON o.t = n.t
), held AS (
    SELECT folder AS above, path, license, score FROM marked
    WHERE name = 'LICENSE' AND license IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, path) = 1
), ups AS (
    SELECT folder, unnest(range(0, len(string_split(folder, '/')) + 1)) AS depth
    FROM (SELECT DISTINCT folder FROM marked)
), nearest AS (
    SELECT u.folder, h.* FROM ups u
    JOIN held h ON array_to_string(string_split(u.folder, '/')[1:u.depth], '/') = h.above
    QUALIFY row_number() OVER (PARTITION BY u.folder ORDER BY u.depth DESC) = 1
)
SELECT m.path, coalesce(m.license, g.license) AS license, coalesce(m.score, g.score) AS score,
    CASE WHEN m.unit = 0 THEN 'file' WHEN m.unit > 0 THEN 'header'
        WHEN g.license IS NOT NULL THEN 'inherited' END AS found,
    CASE WHEN m.license IS NOT NULL THEN m.path ELSE g.path END AS from_path
FROM marked m LEFT JOIN nearest g ON m.folder = g.folder
"""


def _centroid_sql(rounds: int = 10) -> str:
    """Every round written out: nearest centroid by integer distance, then floored means."""
    def nearest(c: str) -> str:
        return f"""SELECT vec_id, v, c, d FROM (
        SELECT vec_id, k.v, c, list_sum(list_transform(
            list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM k CROSS JOIN {c} m
    ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1"""

    steps = "".join(f"""
), a{i} AS MATERIALIZED ({nearest(f"c{i}")}
), s{i} AS (
    SELECT c, i, sum(x) AS s, count(*) AS n
    FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY c, i
), f{i} AS (
    SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{i} GROUP BY c
), c{i + 1} AS MATERIALIZED (
    SELECT o.c, coalesce(f.v, o.v) AS v FROM c{i} o LEFT JOIN f{i} f ON o.c = f.c""" for i in range(rounds))
    return f"""
WITH k AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM k
    QUALIFY c < 8{steps}
), a AS ({nearest(f"c{rounds}")}
)
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance,
    (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a JOIN c{rounds} m ON a.c = m.c
"""


ORACLES = {
    "op4_mix": r"""
WITH d AS (
    SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM d GROUP BY source
), r AS (
    SELECT *, 3.0::DOUBLE * source_size / weight AS fills_at FROM s
), v AS (
    SELECT a.fills_at, ((SELECT sum(source_size) FROM s)
            - 3 * sum(CASE WHEN b.fills_at < a.fills_at THEN b.source_size ELSE 0 END))::DOUBLE
            / sum(CASE WHEN b.fills_at >= a.fills_at THEN b.weight ELSE 0 END)::DOUBLE AS level
    FROM (SELECT DISTINCT fills_at FROM r) a, r b GROUP BY a.fills_at
), t AS (
    SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * (
        SELECT level FROM v WHERE level <= fills_at ORDER BY fills_at LIMIT 1)) AS target
    FROM r
), p AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (CASE WHEN source_size > 0 THEN
        budget // source_size * size
        + greatest(0, least(size, budget % source_size - start)) ELSE 0 END)::BIGINT AS taken
FROM p
""",
    "op5_substring_dedup": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), r AS (
    SELECT doc_id, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM d
), g AS (
    SELECT doc_id, i, word, count(*) OVER ahead AS c, string_agg(word, ' ') OVER ahead AS k
    FROM r WINDOW ahead AS (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), m AS (
    SELECT k, min(doc_id) AS least FROM g WHERE c = 13 GROUP BY k
), h AS (
    SELECT g.doc_id, g.i, g.word, CASE WHEN m.least < g.doc_id THEN 1 ELSE 0 END AS hit
    FROM g LEFT JOIN m ON g.k = m.k AND g.c = 13
), v AS (
    SELECT doc_id, i, word, max(hit) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
    FROM h
), s AS (
    SELECT doc_id, sum(gone)::BIGINT AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
    FROM v GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(s.n_removed, 0) AS n_removed,
    sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
""",
    "op6_license_scan": _license_sql(),
    "op11_embedding_dedup": """
WITH RECURSIVE v AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), ok AS MATERIALIZED (
    SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND list_dot_product(e, e) > 0
        AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM v UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a
), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON vec_id = least.a LEFT JOIN n ON vec_id = n.a
""",
    "op12_prefix_trie": """
WITH t AS MATERIALIZED (
    SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said,
        row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i
    FROM conversations
), c AS MATERIALIZED (
    -- CRC-32 bit by bit: a byte is mixed in, then eight steps follow
    SELECT conv_id, xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(
            string_split(conv_id::VARCHAR, ''),
            lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
            ELSE xor(c // 2, c % 2 * 3988292384) END), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
), r AS (
    SELECT conv_id, i, said FROM t JOIN c USING (conv_id) WHERE i > h UNION ALL
    SELECT c.conv_id, t.i, t.said FROM c JOIN t
    ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.i <= c.h
), s AS MATERIALIZED (
    SELECT c.conv_id, coalesce(s, []) AS s FROM c
    LEFT JOIN (SELECT conv_id, list(said ORDER BY i) AS s FROM r GROUP BY conv_id) USING (conv_id)
), p AS (
    SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s
), n AS MATERIALIZED (
    SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n,
        list(conv_id ORDER BY conv_id) FILTER (WHERE len(s) = d) AS ends
    FROM p GROUP BY ALL
), k AS (
    SELECT p[1:d - 1] AS p, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL
), f AS MATERIALIZED (
    SELECT n.*, coalesce(k.n, 0) AS kids, (n.n - 1) * coalesce(length(n.p[n.d].t), 0) AS saves
    FROM n LEFT JOIN k ON n.p = k.p
), below AS (
    SELECT p[1:u] AS p, sum(saves)::BIGINT AS saved, count(*) FILTER (WHERE kids = 0) AS leaves
    FROM (SELECT p, saves, kids, unnest(range(0, d + 1)) AS u FROM f) GROUP BY ALL
)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n AS n_convs,
    f.kids AS n_children, below.leaves AS n_leaves, below.saved AS saved_tokens,
    sha256(coalesce(array_to_string(f.ends, ','), '')) AS ends_sha256
FROM f JOIN below ON f.p = below.p LEFT JOIN n up ON f.d > 0 AND up.p = f.p[1:f.d - 1]
""",
    "op13_centroids": _centroid_sql(),
}

"""Named queries of the text operators, each over its whole table, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    bpe,
    centroids,
    divergence,
    fingerprints,
    licenses,
    lines,
    packing,
    secret_scan,
    sharding,
    simhash,
    substrings,
    toxicity,
    vectors,
)
from orderloom.llm.columns import documents


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of every text and of its edited text, and their likeness."""
    rows = fingerprints.with_next(documents(spark, sf_dir))
    edited = rows.withColumn("edited", fingerprints.tail_replaced(F.col("text"), F.col("next_text")))
    sketched = edited.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    own, other = F.col("sketch"), F.col("edited_sketch")
    return sketched.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(other).alias("edited_fingerprint"),
        fingerprints.resemblance(own, other).cast("double").alias("near_edited"),
        fingerprints.resemblance(own, F.col("next_sketch")).cast("double").alias("near_next"),
        fingerprints.containment(own, other).cast("double").alias("within_edited"),
        fingerprints.distinct_shingles(own).alias("distinct_shingles"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_documents(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_report(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(documents(spark, sf_dir))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(documents(spark, sf_dir))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(documents(spark, sf_dir))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_fingerprints,
        op2_bpe,
        op3_simhash,
        op4_packing,
        op5_substrings,
        op6_toxicity,
        op7_line_dedup,
        op8_vectors,
        op9_sharding,
        op10_secrets,
        op11_licenses,
        op12_divergence,
        op13_centroids,
    )
}

# Every line that is not blank counts; its first occurrence by (doc_id, position) stays.
OP7_SQL = r"""
WITH cut AS (
    SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, coalesce(source, '') AS site, unnest(parts) AS line,
           unnest(generate_series(0, len(parts) - 1)) AS pos
    FROM cut
), spread AS (
    SELECT line, count(DISTINCT site) AS sites, min({'doc': doc_id, 'pos': pos}) AS first
    FROM lines
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    GROUP BY line
), gone AS (
    SELECT l.doc_id, l.pos
    FROM lines l JOIN spread s ON l.line = s.line
    WHERE s.sites >= 5 AND NOT (l.doc_id = s.first.doc AND l.pos = s.first.pos)
), kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
           coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
    GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines,
       coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       length(coalesce(k.text, ''))::BIGINT AS n_chars_kept,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

# Every window's words as one text; covered words are those of a window that a smaller doc_id has.
OP5_SQL = r"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS seq
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS pos FROM cut)
), least AS (
    SELECT seq, min(doc_id) AS first_doc FROM windows GROUP BY seq HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 12)) AS pos
    FROM windows JOIN least USING (seq) WHERE first_doc < doc_id
), words AS (
    SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM cut
), kept AS (
    SELECT w.doc_id, count(g.pos) AS n_removed,
           coalesce(string_agg(w.word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL), '') AS text
    FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos
    GROUP BY w.doc_id
)
SELECT c.doc_id, len(c.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM cut c LEFT JOIN kept k USING (doc_id)
"""



def op11_sql() -> str:
    """Every block of every text against every template, without filters; phrases word by word."""
    templates = ", ".join(
        f"({k}, '{t.label}', {len(t.sequence)}, {t.need}, {sorted(t.words)})"
        for k, t in enumerate(licenses.TEMPLATES)
    )
    phrases = ", ".join(f"({phrase.split(' ')}, '{label}')" for phrase, label in licenses.PHRASES.items())
    return rf"""
WITH templates(template, label, n, need, parts) AS (VALUES {templates}),
phrases(parts, label) AS (VALUES {phrases}),
d AS (
    SELECT row_number() OVER () AS id, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), placed AS (
    SELECT id, unnest(words) AS word, unnest(generate_series(0, len(words) - 1)) AS pos FROM d
), base AS (
    SELECT p.id, f.label, p.pos
    FROM placed p JOIN phrases f ON p.word = f.parts[1] JOIN d ON d.id = p.id
    WHERE d.words[p.pos + 1:p.pos + len(f.parts)] = f.parts
), by_base AS (
    SELECT id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM base GROUP BY id
), blocks AS (
    SELECT p.id, t.template, t.label, t.need, len(t.parts) AS size, p.word,
           unnest([p.pos // t.n, p.pos // t.n - 1]) AS block
    FROM placed p JOIN (SELECT *, unnest(parts) AS word FROM templates) t ON p.word = t.word
), found AS (
    SELECT id, label, count(DISTINCT word) / any_value(size) AS containment
    FROM blocks WHERE block >= 0
    GROUP BY id, template, label, block HAVING count(DISTINCT word) >= any_value(need)
), labels AS (
    SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT id, label FROM found UNION ALL SELECT id, label FROM base) GROUP BY id
), scores AS (SELECT id, max(containment) AS score FROM found GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN by_base USING (id) LEFT JOIN labels USING (id) LEFT JOIN scores USING (id)
"""


# Every group with every kept term of its language, zeros included.
OP12_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), words AS (
    SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), counted AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT DISTINCT lang, source FROM d
), filled AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
    FROM groups g JOIN kept k ON g.lang = k.lang
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), own AS MATERIALIZED (
    SELECT lang, source, term, n,
           1 + (1000000000 * (n + 1)) // (sum(n) OVER g + count(*) OVER g)::HUGEINT AS p
    FROM filled WINDOW g AS (PARTITION BY lang, source)
), langs AS (
    SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER l + count(*) OVER l)::HUGEINT AS p
    FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM own GROUP BY lang, term)
    WINDOW l AS (PARTITION BY lang)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), every_pair AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), terms AS (
    SELECT o.lang, o.source, o.term AS item, (((o.p - l.p) * (o.p - l.p)) // l.p)::BIGINT AS value
    FROM own o JOIN langs l ON o.lang = l.lang AND o.term = l.term
    WHERE o.n > 0 AND o.p > l.p
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value FROM every_pair
    UNION ALL
    SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked
QUALIFY part = 'pair' OR rank <= 200
"""


def op13_sql(clusters: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS) -> str:
    """All vectors against all centroids, one pair of common tables for each round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
    SELECT r, cluster, sum((x - c) * (x - c)) AS distance
    FROM points JOIN book{k} USING (pos) GROUP BY r, cluster
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1
)""")
        if k < rounds:
            # Division truncates; the remainder made positive gives the floor.
            steps.append(f"""book{k + 1} AS MATERIALIZED (
    SELECT b.cluster, b.pos, coalesce((s - ((s % n) + n) % n) // n, b.c) AS c
    FROM book{k} b LEFT JOIN (
        SELECT cluster, pos, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
        FROM near{k} JOIN points USING (r) GROUP BY cluster, pos
    ) m ON m.cluster = b.cluster AND m.pos = b.pos
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           [floor(1024 * x::DOUBLE)::HUGEINT FOR x IN embedding] AS point
    FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF isfinite(x)]) = 64
), points AS MATERIALIZED (
    SELECT r, unnest(point) AS x, unnest(generate_series(0, 63)) AS pos FROM kept
), started AS (
    SELECT r, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), point) - 1 AS cluster
    FROM kept
), book0 AS MATERIALIZED (
    SELECT cluster, pos, x AS c FROM started JOIN points USING (r) WHERE cluster < {clusters}
), {", ".join(steps)}, marks AS (
    SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256
    FROM book{rounds} GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN marks USING (cluster)
"""


ORACLES: dict[str, str] = {
    "op5_substrings": OP5_SQL,
    "op7_line_dedup": OP7_SQL,
    "op11_licenses": op11_sql(),
    "op12_divergence": OP12_SQL,
    "op13_centroids": op13_sql(),
}

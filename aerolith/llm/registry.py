"""Queries of this package and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import (
    centroids,
    collocations,
    decontamination,
    exact_dedup,
    html_text,
    language,
    licences,
    ngram_join,
    pieces,
    simhash,
    token_counts,
    urls,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.report(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.report(table(spark, sf_dir, "pages"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.report(table(spark, sf_dir, "documents"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_html_text": op6_html_text,
    "op7_language_id": op7_language_id,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_licence_scan": op9_licence_scan,
    "op10_warc": op10_warc,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_ngram_join": op12_ngram_join,
    "op13_centroid_clustering": op13_centroid_clustering,
}


def _clustering_sql(rounds: int) -> str:
    """Assignment and means written out once per round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS (
  SELECT row, vec_id, p, k, d FROM (
    SELECT row, vec_id, p, k, list_sum([(p[i] - c[i]) * (p[i] - c[i]) for i in range(1, 65)]) AS d
    FROM kept, c{i})
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1),
s{i} AS (SELECT k, i, sum(p[i]) AS total, count(*) AS n FROM a{i}, range(1, 65) t(i) GROUP BY k, i),
m{i} AS (
  SELECT k, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{i} GROUP BY k),
c{i + 1} AS (SELECT k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS p
  FROM embeddings
  WHERE len(embedding) = 64
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x) AND abs(x) <= 2097152]) = 64),
c0 AS (
  SELECT place - 1 AS k, p AS c
  FROM (SELECT p, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, p) AS place FROM kept)
  WHERE place <= 16),{",".join(steps)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)"""



ORACLES = {
    "op2_benchmark_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
starts AS (
  SELECT item_id, words, least(len(words), 10) AS n,
         unnest(range(1, len(words) - least(len(words), 10) + 2)) AS s
  FROM b WHERE len(words) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[s:s + n - 1], ' ') AS phrase FROM starts),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_starts AS (
  SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, lengths WHERE len(words) >= n),
doc_windows AS (SELECT r, n, s, array_to_string(words[s:s + n - 1], ' ') AS phrase FROM doc_starts),
found AS (SELECT r, n, s, item_id FROM doc_windows JOIN item_windows USING (n, phrase)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL)
  GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op4_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f""",
    "op11_phrase_mining": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
starts AS (
  SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS s
  FROM w, (VALUES (1), (2), (3)) sizes(k) WHERE len(words) >= k),
f AS (
  SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts GROUP BY ALL),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, j, l.f AS l, r.f AS r,
         (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:c.j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.j + 1:c.k], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
parts AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, array_to_string(words[i:i + 1], ' ') AS phrase, a AS f FROM c, range(1, 3) t(i) WHERE k = 3)
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN parts USING (lang, phrase)
  WHERE s.k = 3 OR longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
    "op12_ngram_join": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
starts AS (SELECT r, words, least(len(words), 5) AS k, unnest(range(1, len(words) - least(len(words), 5) + 2)) AS s
           FROM d WHERE len(words) > 0),
shingles AS (SELECT DISTINCT r, array_to_string(words[s:s + k - 1], ' ') AS shingle FROM starts),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT x.r AS a, y.r AS b, count(*) AS met FROM shingles x JOIN shingles y USING (shingle)
  WHERE x.r <> y.r GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * met >= 80 * (x.n + y.n - met)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
smallest AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY ALL)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (r) JOIN smallest USING (r)""",
    "op13_centroid_clustering": _clustering_sql(centroids.ROUNDS),
}

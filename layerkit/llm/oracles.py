"""SQL for those queries whose results DuckDB can work out on whole tables."""

from __future__ import annotations

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER)
         AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_SEARCH = f"""
WITH held AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM held GROUP BY ALL),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

GIVEN_RULES = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rests AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests)
SELECT p.page_id, p.host, p.path, g.host || g.path AS rule, g.verdict AS given_verdict
FROM parts p LEFT JOIN rules g
  ON (p.host = g.host OR ends_with(p.host, '.' || g.host)) AND starts_with(p.path, g.path)
QUALIFY row_number() OVER (PARTITION BY p.r ORDER BY length(g.host) + length(g.path) DESC, length(g.host) DESC) = 1
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_COUNTS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS i FROM twice) GROUP BY r),
lines AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN lines USING (r) LEFT JOIN covered USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM twice),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS k FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   AND list_cosine_similarity(a.e, b.e) >= 0.98),
reached(id, least) USING KEY (id) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.a, min(s.least) FROM reached s JOIN links l ON l.b = s.id JOIN recurring.reached o ON o.id = l.a
  WHERE s.least < o.least GROUP BY l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least AS component_id, id = least AS kept
FROM reached LEFT JOIN counted ON a = id
"""

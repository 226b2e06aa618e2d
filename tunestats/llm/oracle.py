"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from tunestats.llm import mixing, rules

SPLIT = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

WARC = """
WITH given AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (SELECT *, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS least FROM given)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
         ((strpos('0123456789abcdef', substr(x, CAST(5 * i // 4 + 1 AS INTEGER), 1)) - 1) * 16
           + strpos('0123456789abcdef', substr(x, CAST(5 * i // 4 + 2 AS INTEGER), 1)) - 1) >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31 AS INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id > least THEN least END AS refers_to, TRUE AS digest_ok
FROM digests"""

MINHASH = f"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, {SPLIT.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM tokens WHERE len(ws) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM shingles a JOIN shingles b USING (shingle)
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
named AS (SELECT doc_id, MIN(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM named LEFT JOIN sizes USING (doc_id)"""

_SYMBOLS = "[" + "".join(rules.SYMBOLS) + "]"
RULES = rf"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS t, {SPLIT.format(text="coalesce(text, '')")} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
windows AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM tokens WHERE len(ws) >= 3),
again AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM windows),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY doc_id),
counts AS (
  SELECT doc_id, t, ws, ls, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(t) - len(regexp_replace(t, '{_SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM tokens LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         word_chars > 15 * n_words OR word_chars < 2 * n_words OR 10 * n_symbols > 5 * n_words
         OR len(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) > len(regexp_replace(t, '[^\p{{Ll}}]', '', 'g'))
         OR 10 * len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) < 7 * n_words
         OR 10 * len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\t]*[-•*]'))) > 9 * len(ls)
         OR 10 * len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t\r]*$'))) > 3 * len(ls)
         OR 10 * len(list_distinct(ws)) < n_words AS rejected
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR rejected) AS kept FROM judged"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({SPLIT.format(text="coalesce(text, '')")}) AS BIGINT) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key FROM documents),
sources AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2 * source_size AS cap FROM sources),
filled AS (
  SELECT *, row_number() OVER o AS k, (CAST(1.5 AS DOUBLE) * SUM(source_size) OVER () - SUM(cap) OVER o + cap) / (SUM(w) OVER () - SUM(w) OVER o + w) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), w * (SELECT arg_min(level, k) FROM filled WHERE level * w <= cap)) AS target FROM weighed),
goals AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal FROM targets),
placed AS (
  SELECT *, CAST(coalesce(SUM(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM sized)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
       goal // source_size * size + greatest(0, least(size, goal % source_size - before)) END AS taken
FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source"""

NEGATIVES = """
WITH given AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scores AS (
  SELECT a.k, a.vec_id AS anchor_id, a.label AS own, r.k AS other, r.vec_id, r.label, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM given a JOIN given r ON a.k <> r.k AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id, other) AS r FROM scores WHERE own = label),
far AS (
  SELECT n.k, n.anchor_id, n.other, n.vec_id AS positive_id, s.vec_id AS negative_id, n.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY n.k, n.other ORDER BY s.score DESC, s.vec_id, s.other) AS r
  FROM near n JOIN scores s ON s.k = n.k AND s.label <> n.own AND 30 * n.score <= 100 * s.score AND 100 * s.score <= 90 * n.score WHERE n.r <= 5)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM far WHERE r <= 10"""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
seen AS (SELECT k, lang, source, unnest(ws) AS term FROM docs),
kept AS (SELECT lang, term, COUNT(*) AS c FROM seen GROUP BY lang, term HAVING COUNT(DISTINCT k) >= 10),
langs AS (SELECT lang, COUNT(*) AS v, SUM(c) AS n FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, COUNT(*) AS c FROM seen JOIN kept USING (lang, term) GROUP BY lang, source, term),
known AS (SELECT DISTINCT lang, source FROM docs),
sums AS (SELECT lang, source, SUM(c) AS n FROM held GROUP BY lang, source),
smooth AS (
  SELECT k.lang, k.source, t.term, coalesce(h.c, 0) AS c, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(h.c, 0) + 2)) // (coalesce(s.n, 0) + 2 * l.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (t.c + 2)) // (l.n + 2 * l.v) AS q
  FROM known k JOIN kept t USING (lang) JOIN langs l USING (lang) LEFT JOIN sums s ON s.lang = k.lang AND s.source = k.source
  LEFT JOIN held h ON h.lang = k.lang AND h.source = k.source AND h.term = t.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM smooth a JOIN smooth b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM known a JOIN known b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM smooth WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 10"""

STATEMENTS = {"op5_warc": WARC, "op7_minhash": MINHASH, "op8_rules": RULES, "op11_negatives": NEGATIVES, "op12_divergence": DIVERGENCE, "op13_mixing": MIXING}

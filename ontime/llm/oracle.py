"""The corpus queries in SQL for another engine, where SQL can express them."""

WORDS = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(0)) || ':' || coalesce(text, chr(0))), 1, 15) AS BIGINT) AS h
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT *, 3 * source_size AS lim, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM totals),
weighed AS (SELECT *, CASE pos % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM placed),
leveled AS (
  SELECT *, CAST((SELECT sum(source_size) FROM totals)
      - sum(lim) OVER o + lim AS DOUBLE) / CAST((SELECT sum(w) FROM weighed) - sum(w) OVER o + w AS DOUBLE) AS level
  FROM weighed
  WINDOW o AS (ORDER BY lim * (10 // w), pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
targets AS (
  SELECT source, source_size, least(CAST(lim AS DOUBLE), (SELECT max(level) FROM leveled) * CAST(w AS DOUBLE)) AS target
  FROM leveled),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS repeats FROM targets),
budgets AS (SELECT *, target - CAST(repeats * source_size AS DOUBLE) AS budget FROM plan),
hashes AS (SELECT source, h, sum(size) AS words FROM sized GROUP BY source, h),
ranked AS (
  SELECT x.source, x.h, x.words, b.budget, sum(x.words) OVER (PARTITION BY x.source ORDER BY x.h) AS upto
  FROM hashes x JOIN budgets b ON x.source IS NOT DISTINCT FROM b.source
  WHERE b.budget > 0 AND b.repeats < 3),
ends AS (
  SELECT source, CASE WHEN upto - budget <= budget - (upto - words) THEN h + 1 ELSE h END AS below
  FROM ranked WHERE upto >= budget AND upto - words < budget)
SELECT s.doc_id, s.size, b.source_size, b.target,
  CAST(s.size * (b.repeats + CASE WHEN s.h < coalesce(e.below, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN ends e ON s.source IS NOT DISTINCT FROM e.source
"""

CHAT = r"""
WITH asked AS (SELECT DISTINCT conv_id, turn, text FROM conversations WHERE role = 'user'),
starts AS (
  SELECT *, EXISTS (SELECT 1 FROM asked q WHERE q.conv_id = a.conv_id AND q.turn = a.turn - 2) AS follows FROM asked a),
runs AS (
  SELECT *, max(CASE WHEN NOT follows THEN turn END) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS head FROM starts),
calls AS (
  SELECT conv_id, turn, 'call-' || conv_id || '-' || turn AS call_id,
    CASE WHEN turn > 1 THEN 'follow' ELSE 'open' END AS tool,
    '{' || CASE WHEN follows THEN '"after":"call-' || conv_id || '-' || (turn - 2) || '",' ELSE '' END
      || '"prompt":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '}' AS arguments,
    concat_ws(',', CASE WHEN turn > 1 AND NOT follows THEN 'after' WHEN turn <= 1 AND follows THEN 'after' END,
      CASE WHEN length(text) NOT BETWEEN 1 AND 400 THEN 'prompt' END) AS errors,
    CAST((turn - head) // 2 AS BIGINT) AS depth
  FROM runs),
answers AS (
  SELECT conv_id, turn AS position, text, 'call-' || conv_id || '-' || (turn - 1) AS call_id
  FROM conversations WHERE role = 'assistant'),
linked AS (
  SELECT coalesce(c.conv_id, a.conv_id) AS thread, coalesce(c.call_id, a.call_id) AS call_id, tool, position, depth,
    CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN errors <> '' THEN 'invalid'
      WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'ok' END AS status, errors, arguments, text
  FROM calls c FULL JOIN answers a USING (conv_id, call_id))
SELECT thread, call_id, tool, position, depth, status, errors,
  '{"arguments":' || coalesce(CAST(to_json(arguments) AS VARCHAR), 'null') || ',"id":"' || call_id || '","result":'
    || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"tool":' || coalesce('"' || tool || '"', 'null') || '}' AS json
FROM linked
UNION ALL
SELECT conv_id, NULL, NULL, turn, NULL, 'message', NULL,
  '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}'
FROM conversations WHERE coalesce(role, '') NOT IN ('user', 'assistant')
"""

URLS = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
judged AS (
  SELECT p.*, (
    SELECT max({'size': length(r.host) + length(r.path), 'host_size': length(r.host), 'verdict': r.verdict, 'rule': r.host || r.path})
    FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS best
  FROM parts p)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

QUALITY = rf"""
WITH d AS (SELECT *, row_number() OVER () AS k, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
toks AS (
  SELECT k, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
wins AS (
  SELECT k, i, CASE WHEN count(*) OVER five = 5 THEN list(word) OVER five END AS five
  FROM toks WINDOW five AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
dup AS (SELECT k, i, CASE WHEN five IS NOT NULL AND count(*) OVER (PARTITION BY k, five) > 1 THEN 1 ELSE 0 END AS twice FROM wins),
cov AS (
  SELECT k, CAST(sum(hit) AS BIGINT) AS n_repeat_words FROM (
    SELECT k, max(twice) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM dup)
  GROUP BY k),
lines AS (
  SELECT k, source, text, line FROM (
    SELECT k, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d)),
normal AS (
  SELECT *, lower(regexp_replace(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM lines),
dups AS (SELECT k, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines FROM normal WHERE norm <> '' GROUP BY k),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
freq AS (
  SELECT source, norm FROM (SELECT source, norm, count(DISTINCT text) AS n FROM normal WHERE norm <> '' GROUP BY source, norm) x
  JOIN hosts USING (source) WHERE n >= 10 AND 100 * n > 10 * docs),
rest AS (
  SELECT k, sum(len(regexp_extract_all(line, '{WORDS}'))) AS words_left FROM normal n
  WHERE NOT EXISTS (SELECT 1 FROM freq f WHERE f.source = n.source AND f.norm = n.norm) GROUP BY k),
signals AS (
  SELECT d.k, d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(coalesce(words_left, 0) AS BIGINT) AS words_left
  FROM d LEFT JOIN cov USING (k) LEFT JOIN dups USING (k) LEFT JOIN rest USING (k)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM signals)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, words_left,
  NOT base_failed AND NOT 100 * words_left < 20 * n_words AS kept
FROM judged
"""

WARC = r"""
WITH records AS (
  SELECT page_id, url, substr(md5(coalesce(url, '')), 1, 2) AS draw,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
    || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages)
SELECT page_id, url, CAST(strlen(record) AS BIGINT) AS n_bytes,
  CASE WHEN draw < '04' THEN 'corrupt' ELSE 'missing' END AS status,
  sha256(record) AS digest_0,
  CASE WHEN draw < '04' THEN sha256(substr(record, 1, length(record) - 1) || chr(0)) END AS digest_1
FROM records WHERE draw < '08'
"""

NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
    ELSE list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) END) AS s FROM d),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
groups AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN groups USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# The given pages have their text in one article of h1, p, b and br elements.
MAIN_TEXTS = r"""
WITH inner_html AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(?:</article>|$)', 1, 's') AS a FROM pages),
bare AS (
  SELECT page_id, url, list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'),
    lambda b: regexp_replace(replace(b, '<br>', ' '), '<[^>]*(>|$)', '', 'g')) AS blocks FROM inner_html),
decoded AS (
  SELECT page_id, url, list_transform(blocks, lambda b:
    trim(regexp_replace(regexp_replace(replace(replace(replace(replace(
      b, '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'),
      '&amp;?', '&', 'g'), '[\s\v]+', ' ', 'g'))) AS blocks FROM bare),
joined AS (
  SELECT page_id, url, array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10) || chr(10)) AS text FROM decoded)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
"""

TOP_K = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""

PHRASES = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
one AS (SELECT lang, g, CAST(count(*) AS HUGEINT) AS n FROM (SELECT lang, unnest(w) AS g FROM pieces) x GROUP BY lang, g),
two AS (
  SELECT lang, g, CAST(count(*) AS HUGEINT) AS n FROM (
    SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
    FROM pieces WHERE len(w) > 1) x GROUP BY lang, g),
three AS (
  SELECT lang, g, CAST(count(*) AS HUGEINT) AS n FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g
    FROM pieces WHERE len(w) > 2) x GROUP BY lang, g HAVING count(*) >= 10),
parts AS (
  SELECT lang, g, n, split_part(g, ' ', 1) AS head, split_part(g, ' ', 3) AS last,
    split_part(g, ' ', 1) || ' ' || split_part(g, ' ', 2) AS start, split_part(g, ' ', 2) || ' ' || split_part(g, ' ', 3) AS rest
  FROM three),
inside AS (
  SELECT lang, part, max(n) AS longer FROM (
    SELECT lang, start AS part, n FROM parts UNION ALL SELECT lang, rest, n FROM parts) x GROUP BY lang, part),
cuts AS (
  SELECT c.lang, c.g, c.n AS a, 1 AS cut, x.n AS l, y.n AS r
  FROM two c JOIN one x ON x.lang = c.lang AND x.g = split_part(c.g, ' ', 1)
  JOIN one y ON y.lang = c.lang AND y.g = split_part(c.g, ' ', 2)
  LEFT JOIN inside i ON i.lang = c.lang AND i.part = c.g
  WHERE c.n >= 10 AND (i.longer IS NULL OR 100 * i.longer < 50 * c.n)
  UNION ALL
  SELECT c.lang, c.g, c.n, 1, x.n, y.n FROM parts c
  JOIN one x ON x.lang = c.lang AND x.g = c.head JOIN two y ON y.lang = c.lang AND y.g = c.rest
  UNION ALL
  SELECT c.lang, c.g, c.n, 2, x.n, y.n FROM parts c
  JOIN two x ON x.lang = c.lang AND x.g = c.start JOIN one y ON y.lang = c.lang AND y.g = c.last),
scored AS (SELECT *, CAST(1000000 AS HUGEINT) * a * a // (l * r) AS score FROM cuts),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM least),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM one GROUP BY lang)
SELECT lang, rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  t.n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
"""

EXACT = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM t WINDOW same AS (PARTITION BY text)
"""

ORACLE: dict[str, str] = {
    "op1_source_mix": MIX,
    "op2_chat_calls": CHAT,
    "op3_main_texts": MAIN_TEXTS,
    "op6_url_verdicts": URLS,
    "op7_quality_rules": QUALITY,
    "op8_near_duplicates": NEAR,
    "op9_warc_fixity": WARC,
    "op10_exact_top_k": TOP_K,
    "op11_collocations": PHRASES,
    "op13_exact_duplicates": EXACT,
}

"""DuckDB SQL for the queries that SQL can express."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
), urls AS (
  SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts
), rules(rule, rule_host, rule_path, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
  SELECT page_id, rule, verdict, row_number() OVER (
    PARTITION BY page_id ORDER BY length(rule) DESC) AS place
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fits f ON f.page_id = u.page_id AND f.place = 1
"""

OP7 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), hashed AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, sha256(html) AS strong
  FROM payloads
), newest AS (
  SELECT strong, max(page_id) AS newest FROM hashed GROUP BY strong
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((('0x' || substr(hex, 1 + 10 * CAST(i // 8 AS INT), 10))::BIGINT
      >> (35 - 5 * (i % 8))::BIGINT) & 31 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM hashed JOIN newest USING (strong)
"""

_WORDS = (
    f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP10 = f"""
WITH doc_words AS (
  SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents
), item_words AS (
  SELECT item_id, {_WORDS} AS words FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
    unnest(list_transform(range(1, len(words) - least(10, len(words)) + 2),
      lambda i: array_to_string(words[i : i + least(10, len(words)) - 1], ' '))) AS window_words
  FROM item_words WHERE len(words) > 0
), doc_windows AS (
  SELECT doc_id, n, unnest(range(1, len(words) - n + 2)) AS place,
    unnest(list_transform(range(1, len(words) - n + 2),
      lambda i: array_to_string(words[i : i + n - 1], ' '))) AS window_words
  FROM doc_words, (SELECT DISTINCT n FROM item_windows)
  WHERE len(words) >= n
), hits AS (
  SELECT doc_id, item_id, place, n FROM doc_windows JOIN item_windows USING (n, window_words)
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(place, place + n)) AS word FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP12 = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

OP13 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n_lang FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(n_lang) AS n FROM kept GROUP BY lang
), held AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, any_value(langs.n) AS of_lang, coalesce(any_value(total), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM held GROUP BY ALL) USING (lang, source)
  GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 5)) // (g.n + 5 * g.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.n_lang + 5)) // (g.of_lang + 5 * g.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN held h USING (lang, source, term)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM results QUALIFY part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op2_url_filter": OP2,
    "op7_line_dedup": OP7,
    "op8_warc": OP8,
    "op10_decontamination": OP10,
    "op12_hard_negatives": OP12,
    "op13_divergence": OP13,
}

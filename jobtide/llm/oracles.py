"""The SQL that registered queries are checked against, stated for DuckDB over the same tables."""

_LOWERED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH item AS (
  SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), gram AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(0, len(w) - 12) + 1 + CASE WHEN len(w) BETWEEN 1 AND 12 THEN 1 ELSE 0 END)) AS p FROM item)
), doc AS (
  SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents
), here AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM gram))
), hit AS (
  SELECT doc_id, item_id, p, n FROM here JOIN gram USING (n, g)
), items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN items USING (doc_id) LEFT JOIN covered USING (doc_id)
"""

OP2 = """
WITH rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rest AS (
  SELECT page_id, row_number() OVER () AS n,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parsed AS (
  SELECT page_id, n, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fit AS (
  SELECT n, arg_max(h || p, len(h || p)) AS rule, arg_max(v, len(h || p)) AS verdict
  FROM parsed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN fit USING (n)
"""

OP7 = """
WITH doc AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), win AS (
  SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(1, len(h) // 2 - 50 + 2)) AS p FROM doc)
), hit AS (
  SELECT doc_id, p FROM win JOIN (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING count(*) > 1) USING (s)
  WHERE first < doc_id
), span AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM (
    SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (
      SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM hit))
  GROUP BY doc_id, g
), piece AS (
  SELECT doc_id, a, z - a AS n, substr(h, 2 * coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) - 1,
    2 * (a - coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1))) AS before FROM span JOIN doc USING (doc_id)
), kept AS (
  SELECT doc_id, sum(n) AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY a) AS head, max(a + n) AS z
  FROM piece GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head || substr(h, 2 * z - 1), h))) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

ORACLES = {"op1_benchmark_decontamination": OP1, "op2_url_filter": OP2, "op7_suffix_array_dedup": OP7}

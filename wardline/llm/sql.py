"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {}

ORACLES["op10_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest FROM pages),
urls AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fitting AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS place
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fitting WHERE place = 1) USING (page_id)
"""

ORACLES["op7_line_dedup"] = r"""
WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
starts AS (SELECT doc_id, l, unnest(range(0, greatest(len(l) - 2, 0))) AS line FROM lines),
windows AS (
  SELECT doc_id, line, l[line + 1] AS a, l[line + 2] AS b, l[line + 3] AS c FROM starts
  WHERE regexp_matches(l[line + 1] || l[line + 2] || l[line + 3], '[^\x20\x09-\x0D]')),
later AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, line) AS n FROM windows),
gone AS (
  SELECT doc_id, list_distinct(flatten(list([line, line + 1, line + 2]))) AS g FROM later WHERE n > 1 GROUP BY doc_id)
SELECT doc_id, CASE WHEN g IS NULL THEN text ELSE coalesce(array_to_string(
    list_filter(list_transform(range(0, len(l)), lambda i: CASE WHEN list_contains(g, i) THEN NULL ELSE l[i + 1] END),
      lambda x: x IS NOT NULL), chr(10)), '') END AS text,
  CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed
FROM documents JOIN lines USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

ORACLES["op4_embed_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT node, v FROM reached JOIN links ON u = other)
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE u = node) AS n_links,
  min(other) AS component_id, node = min(other) AS kept
FROM reached GROUP BY node
"""

"""SQL twins for DuckDB that are longer than a query or two.

Substring dedup has none: windows at every byte take minutes even on the smaller tables,
so its query is tested against a search with sets.
"""

NEAR_COPIES = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, md5(unnest(s)) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS r FROM both_ways UNION SELECT b, r FROM reach JOIN both_ways ON a = doc_id )
SELECT z.doc_id, z.n AS n_shingles, coalesce(min(r), z.doc_id) AS component_id
FROM sizes z LEFT JOIN reach ON reach.doc_id = z.doc_id GROUP BY z.doc_id, z.n
"""

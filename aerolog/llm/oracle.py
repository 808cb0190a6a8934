"""The queries of this folder that SQL can express, for DuckDB."""

from __future__ import annotations

OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
found AS (
  SELECT p.row_id, p.i, p.size, x.item
  FROM (SELECT row_id, size, w, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size) AS p
  JOIN windows AS x ON x.size = p.size AND x.win = array_to_string(p.w[p.i:p.i + p.size - 1], ' ')),
hit AS (
  SELECT row_id, count(DISTINCT place) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY row_id),
items AS (
  SELECT row_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row_id) LEFT JOIN items USING (row_id)
"""

OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL) AS p
  JOIN n AS na ON na.doc_id = p.a JOIN n AS nb ON nb.doc_id = p.b
  WHERE 100 * p.k >= 75 * (na.n + nb.n - p.k)),
reach AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach AS r JOIN links AS l ON l.a = r.other),
c AS (SELECT doc_id, least(doc_id, min(other)) AS component FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id,
       coalesce(c.component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""

OP13 = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30),
c AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept AS k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT f.lang, f.source, f.term, f.n,
         1 + (1000000000::HUGEINT * (f.n + 5)) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + 5 * v.v) AS p
  FROM filled AS f JOIN v ON v.lang = f.lang),
q AS (
  SELECT f.lang, f.term, 1 + (1000000000::HUGEINT * (f.n + 5)) // (sum(f.n) OVER (PARTITION BY f.lang) + 5 * v.v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM filled GROUP BY lang, term) AS f JOIN v ON v.lang = f.lang),
distance AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p AS x JOIN p AS y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY ALL),
items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g AS a JOIN g AS b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN distance AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM items QUALIFY part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": OP4, "op6_near_dedup": OP6, "op13_divergence": OP13}

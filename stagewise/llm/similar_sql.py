"""DuckDB SQL of the near-duplicate queries: every pair that shares a shingle, counted."""

from __future__ import annotations


def similar_sql(words: int, percent: int, kept: bool = False) -> str:
    """``doc_id, n_shingles, component_id`` (and ``kept``) of documents whose shingle sets are similar to ``percent``."""
    return f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - {words} + 1, 1) + 1),
    lambda i: array_to_string(w[i : i + {words - 1}], ' '))) END AS shingles FROM cut),
sizes AS (SELECT doc_id, len(shingles)::BIGINT AS n FROM sets),
flat AS (SELECT doc_id, unnest(shingles) AS s FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= {percent} * (min(x.n) + min(y.n) - count(*))),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b)
SELECT d.doc_id, z.n AS n_shingles, min(r.b) AS component_id{', d.doc_id = min(r.b) AS kept' if kept else ''}
FROM documents d JOIN sizes z ON z.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, z.n"""

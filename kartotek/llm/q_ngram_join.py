"""op9: near-duplicate components of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import ngram_join
from kartotek.llm.registry import query, table

SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g
  FROM words
), coded AS (SELECT doc_id, hash(g) AS g FROM shingles
), sizes AS (SELECT doc_id, count(*) AS n FROM coded GROUP BY doc_id
), often AS (SELECT g, count(*) AS f FROM coded GROUP BY g HAVING count(*) > 1
), ranked AS (
  SELECT c.doc_id, c.g, n, row_number() OVER (PARTITION BY c.doc_id ORDER BY coalesce(f, 1), c.g) AS pos
  FROM coded c JOIN sizes USING (doc_id) LEFT JOIN often USING (g)
), prefix AS (SELECT doc_id, g, n FROM ranked WHERE pos <= n - ceil(0.9 * n) + 1
), pairs AS (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM prefix a JOIN prefix b USING (g)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
), overlap AS (
  SELECT x, y, count(*) AS o FROM pairs JOIN coded a ON a.doc_id = x JOIN coded b ON b.doc_id = y AND a.g = b.g
  GROUP BY x, y
), links AS (
  SELECT x, y FROM overlap JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * o >= 90 * (a.n + b.n - o)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT x AS doc_id, x AS root FROM both_ways
  UNION SELECT y, root FROM reached JOIN both_ways ON x = doc_id
), least_root AS (SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_root USING (doc_id)
"""


@query("op9_ngram_jaccard_join", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document (3-word shingles, 0.9)."""
    return ngram_join.shingle_components(table(spark, sf_dir, "documents"), size=3, percent=90)

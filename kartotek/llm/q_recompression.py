"""op7: repeated word sequences of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import recompression
from kartotek.llm.registry import query, table

SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), spots AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13
), windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k FROM spots
), firsts AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k
), hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE doc_id > m
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hits
), each_word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM t
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
  FROM each_word e WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = e.doc_id AND g.p = e.p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""


@query("op7_recompression_dedup", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a smaller document already has in windows of 13."""
    return recompression.remove_repeats(table(spark, sf_dir, "documents"))

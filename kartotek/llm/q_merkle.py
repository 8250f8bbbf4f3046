"""op11: a Merkle manifest of all documents, and the proof of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek.llm import merkle
from kartotek.llm.registry import query, table


def _leaf(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


# CRC-32 of the decimal digits, one shift of eight bits for each: the polynomial is a fixed value.
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda c: ascii(c)::BIGINT)), lambda a, b: xor(a >> 8, list_reduce(list_prepend((xor(a, b) & 255), range(8)), "
        "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))), 4294967295)")

SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS tampered FROM documents
), trees AS (
  SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, count(*) AS n FROM docs GROUP BY source
), leaves AS (
  SELECT d.doc_id, tree, n, leaf, tampered, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM docs d JOIN trees t ON d.source IS NOT DISTINCT FROM t.source
), nodes AS (
  SELECT tree, 0 AS level, pos AS idx, n AS wide, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, (wide + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE wide > 1
  GROUP BY tree, level, idx // 3, wide
), subroots AS (SELECT tree, h AS subroot, level AS up, count(*) OVER () AS k FROM nodes WHERE wide = 1
), tops AS (
  SELECT 0 AS level, tree AS idx, k AS wide, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (wide + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE wide > 1
  GROUP BY level, idx // 3, wide
), roots AS (SELECT h AS root FROM tops WHERE wide = 1
), paths AS (
  SELECT tree, pos, 0 AS level, pos AS spot, n AS wide FROM leaves
  UNION ALL SELECT tree, pos, level + 1, spot // 3, (wide + 2) // 3 FROM paths WHERE wide > 1
), head_paths AS (
  SELECT tree, 0 AS level, tree AS spot, k AS wide FROM subroots
  UNION ALL SELECT tree, level + 1, spot // 3, (wide + 2) // 3 FROM head_paths WHERE wide > 1
), steps AS (
  SELECT p.tree, pos, p.level, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < spot), '') AS l,
         coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > spot), '') AS r
  FROM paths p JOIN nodes m ON m.tree = p.tree AND m.level = p.level AND m.idx // 3 = p.spot // 3
  WHERE p.wide > 1 GROUP BY ALL
), head_steps AS (
  SELECT p.tree, p.level, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < spot), '') AS l,
         coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > spot), '') AS r
  FROM head_paths p JOIN tops m ON m.level = p.level AND m.idx // 3 = p.spot // 3 WHERE p.wide > 1 GROUP BY ALL
), all_steps AS (
  SELECT tree, pos, level, l, r FROM steps
  UNION ALL SELECT tree, pos, up + h.level, l, r FROM head_steps h JOIN subroots USING (tree) JOIN leaves USING (tree)
), proofs AS (SELECT tree, pos, sha256(string_agg(l || r, '' ORDER BY level)) AS proof_sha256, max(level) + 1 AS n_steps FROM all_steps GROUP BY ALL
), folds AS (
  SELECT tree, pos, 0 AS level, tampered AS h FROM leaves
  UNION ALL SELECT f.tree, f.pos, f.level + 1, sha256(l || h || r) FROM folds f JOIN all_steps s
    ON f.tree = s.tree AND f.pos = s.pos AND f.level = s.level
)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, h AS folded_root, h = root AS verified
FROM leaves JOIN subroots USING (tree) CROSS JOIN roots LEFT JOIN proofs USING (tree, pos)
JOIN folds f ON f.tree = leaves.tree AND f.pos = leaves.pos AND f.level = coalesce(n_steps, 0)
"""


@query("op11_merkle_manifest", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a leaf folds to after tampering."""
    def leaf(text):
        return merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = table(spark, sf_dir, "documents").select(
        F.col("source").alias("grp"), F.col("doc_id").alias("id"), leaf(F.col("text")).alias("digest"),
        F.when(tampered, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf(F.col("text"))).alias("tampered"))
    manifest = merkle.build(rows)
    root = F.lit(manifest.root).cast("string")
    return (
        merkle.prove(manifest)
        .select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"),
                merkle.proof_digest(F.col("proof")).alias("proof_sha256"), merkle.fold(F.col("tampered"), F.col("proof")).alias("folded_root"))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )

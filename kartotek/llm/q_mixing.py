"""op4: all documents mixed by source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import mixing
from kartotek.llm.registry import query, table

_HASH = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
_DOC = _HASH.format("coalesce(source, '~') || ':' || coalesce(CAST(doc_id AS VARCHAR), '~')")
_TURN = _HASH.format("coalesce(source, '~') || ':' || CAST(block AS VARCHAR) || ':' || CAST(epoch AS VARCHAR)")
_LAST = _HASH.format("coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || CAST(epoch AS VARCHAR)")

SQL = rf"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents
), sources AS (
  SELECT source, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM counted GROUP BY source HAVING sum(n_tokens) > 0
), facts AS (SELECT list(tokens) AS ts, sum(tokens) AS total, min(tokens) AS least, count(*) AS n FROM sources
), bisection AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS elo, 1.0::DOUBLE AS ehi, ts, total, least, n FROM facts
  UNION ALL
  SELECT i + 1, CASE WHEN h THEN m ELSE lo END, CASE WHEN h THEN hi ELSE m END,
         CASE WHEN e THEN em ELSE elo END, CASE WHEN e THEN ehi ELSE em END, ts, total, least, n
  FROM (
    SELECT *, ln(list_sum(list_transform(ts, lambda t: pow(t, m))))
              - m * list_sum(list_transform(ts, lambda t: pow(t, m) * ln(t))) / list_sum(list_transform(ts, lambda t: pow(t, m)))
              >= {mixing.ENTROPY_SHARE} * ln(n) - 1e-12 AS h,
           total * pow(least, em - 1) / list_sum(list_transform(ts, lambda t: pow(t, em))) > {mixing.MAX_EPOCHS} AS e
    FROM (SELECT *, (lo + hi) / 2 AS m, (elo + ehi) / 2 AS em FROM bisection WHERE i < 34)
  )
), mix AS (
  SELECT greatest(
    CASE WHEN n = 1 OR hi = 1 THEN 1.0 ELSE floor(lo * 1e6) / 1e6 END,
    CASE WHEN total / least / n <= {mixing.MAX_EPOCHS} THEN 0.0 WHEN ehi = 1 THEN 1.0 ELSE ceil(elo * 1e6) / 1e6 END) AS a, total
  FROM bisection WHERE i = 34
), quotas AS (
  SELECT source, tokens, pow(tokens, a) / sum(pow(tokens, a)) OVER () * total AS quota,
         CAST(least(greatest(ceil(tokens / {mixing.BLOCK_TOKENS}), 1), {mixing.MAX_BLOCKS}) AS BIGINT) AS n_blocks
  FROM sources, mix
), parts AS (
  SELECT *, CAST(floor(quota / tokens) AS BIGINT) AS whole, quota - floor(quota / tokens) * tokens AS rest FROM quotas
), keyed AS (
  SELECT c.*, whole, rest, {_DOC.replace('source', 'c.source')} % n_blocks AS block
  FROM counted c JOIN parts p ON c.source IS NOT DISTINCT FROM p.source
), blocks AS (
  SELECT source, block, sum(n_tokens) AS block_tokens, any_value(whole) AS whole, any_value(rest) AS rest FROM keyed GROUP BY source, block
), turns AS (SELECT *, unnest(range(0, whole + 1)) AS epoch FROM blocks
), placed AS (
  SELECT *, row_number() OVER w AS place,
         rest - coalesce(sum(block_tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM turns WINDOW w AS (PARTITION BY source, epoch ORDER BY {_TURN}, block)
), used AS (SELECT *, epoch = whole AND block_tokens > room AS cut FROM placed WHERE epoch < whole OR room > 0
), drawn AS (
  SELECT doc_id, k.source, n_tokens, epoch, place, cut, room, k.block
  FROM keyed k JOIN used u ON k.source IS NOT DISTINCT FROM u.source AND k.block = u.block
), summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, block, cut, epoch ORDER BY {_LAST}, doc_id, n_tokens
                                ROWS UNBOUNDED PRECEDING) AS so_far FROM drawn
)
SELECT doc_id, source, n_tokens, epoch, CAST(place AS INTEGER) AS place FROM summed WHERE NOT cut OR so_far <= room
"""


@query("op4_temperature_mixing", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of a document; the budget is all tokens once."""
    return mixing.draw(table(spark, sf_dir, "documents"))

"""op10: all conversations and one of control strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import chat
from kartotek.llm.registry import query, table

_RESTS = r"\|im_start\|>|\|im_end\|>|\|im_sep\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"

SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, CASE WHEN role = lag(role) OVER w THEN 0 ELSE 1 END AS opens
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)({_RESTS})', '\1\\\2\3', 'g')) AS body,
         -- a block: its markers, role and line ends; a merged turn: a separator
         CASE WHEN opens = 1 THEN 12 + length(role) + 1 + 11 ELSE 10 END AS frame
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + frame) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op10_chat_formatting", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(turns.unionByName(planted)))

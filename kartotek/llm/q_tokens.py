"""op2: token counts of all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import tokens
from kartotek.llm.registry import query, table


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text."""
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

"""op1: nearest neighbours of every hundredth embedding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import ann
from kartotek.llm.registry import query, table


@query("op1_balanced_posting_lists")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found (Euclidean) of each row whose vec_id is divisible by 100, in all rows."""
    vectors = ann.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return ann.search(vectors, vectors.where("id % 100 = 0"), 10)

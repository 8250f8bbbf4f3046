"""op8: documents that hold benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import decontamination
from kartotek.llm.registry import query, table


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, item) pair whose tiles cover at least half of the item."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""op5: main text of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartotek.llm import extraction
from kartotek.llm.registry import query, table


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best contiguous region of every page."""
    return extraction.extract(table(spark, sf_dir, "pages"))

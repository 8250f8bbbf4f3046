"""op3: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek.llm import toxicity
from kartotek.llm.registry import query, table


@query("op3_toxicity_string_kernel")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text by a machine trained on the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")

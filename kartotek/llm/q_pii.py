"""op6: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek.llm import pii
from kartotek.llm.registry import query, table


@query("op6_pii_candidate_boosting")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    order = F.array(*map(F.lit, pii.KINDS))

    def text_of(spans):
        ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
            F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"),
            s["kind"].alias("kind"))))
        return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.slice("spans", F.lit(1), F.col("n_base"))

    def count_of(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count_of, pii.KINDS), F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"),
        (F.size("spans") - F.col("n_base")).cast("long").alias("n_added"))

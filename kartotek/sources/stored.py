"""Readers for what earlier runs stored: state, registry and document pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek import schemas


def harvest_state(rows: DataFrame) -> DataFrame:
    """Stored state with its ISO texts read as instants."""
    return rows.select(
        "provider_code",
        "dataset_code",
        "language",
        fn.parse_ts(F.col("source_updated_at")).alias("source_updated_at"),
        fn.parse_ts(F.col("last_fetched_at")).alias("last_fetched_at"),
        F.coalesce(F.col("has_error"), F.lit(False)).alias("has_error"),
    )


def read_providers(spark: SparkSession, path: str) -> DataFrame:
    """Registry file: one JSON array of provider objects, read with the declared schema."""
    return spark.read.schema(schemas.PROVIDER[7:-1]).option("multiLine", True).json(path)


def providers(raw: DataFrame) -> DataFrame:
    listed = F.from_json("body", f"array<{schemas.PROVIDER}>")
    return raw.select(F.inline(listed))


def documents(raw: DataFrame) -> DataFrame:
    """Stored pairs read back into the typed model."""
    return raw.select(F.from_json("body", schemas.DOCUMENT_PAIR).alias("pair")).select("pair.*")


def write_pairs(pairs: DataFrame, path: str, partition: str = "run_id") -> None:
    """Document pairs as JSON text, one per row, by run."""
    pairs.write.partitionBy(partition).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)

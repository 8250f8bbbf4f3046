"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kartotek.session import fresh_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Outcomes, last-good documents, registry import and run records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.operators.numbering import last_per
from kartotek.session import small_pieces


def classify(should_fetch: Column, error: Column) -> Column:
    """Outcome of one discovered dataset."""
    return (
        F.when(~should_fetch, "skipped").when(error.isNotNull(), "failed").otherwise("saved")
    )


def outcomes(resolved: DataFrame) -> DataFrame:
    """One row per discovered dataset; expects should_fetch, error and documents."""
    kind = classify(F.col("should_fetch"), F.col("error"))
    return (
        resolved.withColumn("outcome", kind)
        .withColumn("error", F.when(F.col("outcome") == "failed", F.col("error")))
        .withColumn("documents", F.when(F.col("outcome") == "saved", F.col("documents")))
        .withColumn(
            "source_updated_at",
            F.when(F.col("outcome") != "skipped", F.col("source_updated_at")),
        )
        .drop("should_fetch")
    )


def write_partitioned(df: DataFrame, path: str, partition: str) -> None:
    """Write by partition; running the same run again replaces just that run's rows. A task sorts
    its rows by partition, so large partitions are written in pieces."""
    with small_pieces(df.sparkSession):
        (
            df.hint("rebalance", partition).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )


def write_outcomes(df: DataFrame, path: str) -> None:
    write_partitioned(outcomes(df), path, "run_id")


def upsert_documents(
    current: DataFrame, saved: DataFrame, keys: Sequence[str], order: str = "run_no"
) -> DataFrame:
    """Last good document per identity: a save replaces the old one, anything else leaves
    it alone. Only the newest of each key crosses the shuffle."""
    return last_per(current.unionByName(saved), keys, [F.col(order)])


def import_registry(
    incoming: DataFrame, existing: DataFrame, key: str, fields: Sequence[str]
) -> DataFrame:
    """Insert-only import: unknown codes are imported, equal rows are unchanged, unequal
    ones are reported and never overwritten. Maps compare as sorted entries."""

    def comparable(df: DataFrame, c: str) -> Column:
        is_map = dict(df.dtypes)[c].startswith("map")
        return F.array_sort(F.map_entries(c)) if is_map else F.col(c)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*[comparable(df, c).alias(c) for c in fields]).alias(name))

    joined = packed(incoming, "_new").join(packed(existing, "_old"), key, "left")
    return joined.select(
        key,
        F.when(F.col("_old").isNull(), "imported")
        .when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged")
        .otherwise("differences")
        .alias("status"),
    )


def run_summary(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Run record: what was discovered and attempted."""
    attempted = F.col("outcome").isin("saved", "failed")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("discovered"),
        F.count_if(attempted).alias("attempts"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
    )


def outcome_summary(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Saved, failed and skipped counts."""
    return rows.groupBy(*keys).agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("saved", "failed", "skipped")]
    )

"""Published runs: outcomes in a folder of their own, and one manifest row that is written last.

A run is published in two phases. Its outcomes go to ``outcomes/run_id=.../attempt=...``; when they are
whole, one row with its status, first error, counts and checkpoint goes to ``runs/run_id=...`` and names
that attempt. Readers start from the manifest, so they see whole runs only: an attempt whose job was killed is
in no row, and running it again writes another attempt and then the row. The row is there for a refused
run too, even if that has not one dataset.

    runs.publish(harvest.run_tables_v2(...), path)
    runs.manifest(spark, path)                  # one row a run
    runs.outcomes(spark, path)                  # outcomes of published runs
    runs.state(spark, path, keys)               # what the next run knows
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek.operators import incremental

MANIFEST = (
    "attempt string, provider_code string, language string, started_at timestamp, status string, error string, limit_n int, "
    "listing_complete boolean, discovered long, attempts long, saved long, failed long, skipped long, deferred long, run_id string"
)

#: A run ended whole, ended at its limit, or was refused.
COMPLETE, BOUNDED, REFUSED = "complete", "bounded", "refused"


def publish(result, path: str, attempt: str | None = None) -> None:
    """Write the outcomes of a result (``run``, ``outcomes``, ``error``), then its row."""
    run, spark = result.run, result.outcomes.sparkSession
    attempt = attempt or uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/outcomes/run_id={run.run_id}/attempt={attempt}"
    result.outcomes.drop("run_id").write.mode("overwrite").parquet(folder)
    # Counted from what was written: the run is not worked out twice.
    kinds = ("saved", "failed", "skipped", "deferred")
    written = spark.read.schema("outcome string").parquet(folder)
    counts = written.agg(F.count("*").alias("discovered"), *[F.count_if(F.col("outcome") == k).alias(k) for k in kinds])
    status = REFUSED if result.error is not None else BOUNDED if run.limit is not None else COMPLETE
    row = counts.select(
        F.lit(attempt).alias("attempt"), F.lit(run.provider_code).alias("provider_code"), F.lit(run.language).alias("language"),
        F.lit(run.started_at).cast("timestamp").alias("started_at"), F.lit(status).alias("status"),
        F.lit(result.error).cast("string").alias("error"), F.lit(run.limit).cast("int").alias("limit_n"),
        F.lit(status == COMPLETE).alias("listing_complete"), "discovered", (F.col("saved") + F.col("failed")).alias("attempts"), *kinds)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/runs/run_id={run.run_id}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each published run."""
    return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/runs")


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes of the published attempts. The manifest prunes the folders that are read."""
    published = manifest(spark, path).select("run_id", "attempt", "started_at")
    stored = spark.read.option("basePath", f"{path.rstrip('/')}/outcomes").parquet(f"{path.rstrip('/')}/outcomes/run_id=*")
    stored = stored.withColumns({"run_id": F.col("run_id").cast("string"), "attempt": F.col("attempt").cast("string")})
    return stored.join(published, ["run_id", "attempt"])


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Start of the latest complete run of each provider and language."""
    return incremental.advance_checkpoint(manifest(spark, path), ["provider_code", "language"])


def state(spark: SparkSession, path: str, keys: Sequence[str] = incremental.IDENTITY) -> DataFrame:
    """State after all published runs, the later start winning; refused runs keep it as it was."""
    whole = manifest(spark, path).filter(F.col("status") != REFUSED).select("run_id")
    news = outcomes(spark, path).join(whole, "run_id", "left_semi").withColumn("ts", F.col("started_at"))
    order = ["started_at", "run_id"]
    return incremental.state_from_facts(incremental.outcome_facts(news, keys, order), keys)

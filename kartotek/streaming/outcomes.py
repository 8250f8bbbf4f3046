"""Streams of outcomes and listings.

No watermark is used on purpose: an older date counts as a change, so nothing may be
dropped for being late. Replays are harmless: outcomes are folded into a fact log that knows which
batches it has, and a selection is kept under its batch with the generation of the state it was
made from, which a replay uses again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kartotek import schemas
from kartotek.operators.incremental import IDENTITY, next_state, outcome_facts, select_by_timestamp
from kartotek.streaming.generations import FactLog


def stream_outcomes(
    source: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]
) -> StreamingQuery:
    """Fold each micro-batch of outcomes into the fact log at ``path``."""
    log = FactLog(source.sparkSession, path, keys)

    def store(batch: DataFrame, batch_id: int) -> None:
        log.add(outcome_facts(batch, keys, order), batch_id)

    return (
        source.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """State as of the last finished micro-batch; none yet: an empty one."""
    state = FactLog(spark, path, keys).state()
    if state is None:
        return spark.createDataFrame([], schemas.STATE).select(*keys, "source_updated_at", "last_fetched_at", "has_error")
    return state


def stream_select(
    source: DataFrame,
    state: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = IDENTITY,
    log: FactLog | None = None,
) -> StreamingQuery:
    """Match arriving listing rows to the stored state and write the selection, one folder a batch.

    With ``log``, each micro-batch lays the newest generation of the fact log over ``state``, so a
    dataset saved between two batches is known to the second. The generation is noted before the
    selection is written; a replay of the batch takes the same one, if it is still kept."""
    spark = source.sparkSession

    def choose(batch: DataFrame, batch_id: int) -> None:
        known = state
        if log is not None:
            generation = _noted(spark, f"{path}/generation/batch_id={batch_id}", log)
            news = log.facts(generation)
            if news is not None:
                known = next_state(state, None, list(keys), [], facts=news)
        select_by_timestamp(batch, known, keys=keys).write.mode("overwrite").parquet(f"{path}/selected/batch_id={batch_id}")

    return (
        source.writeStream.foreachBatch(choose)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _noted(spark: SparkSession, path: str, log: FactLog) -> int | None:
    """The generation noted for a batch, or the newest, which is noted now."""
    kept = log.generations()
    fs, p = log._fs(f"{path}/_SUCCESS")
    if fs.exists(p):
        noted = spark.read.schema("generation long").parquet(path).first()["generation"]
        if noted is None or noted in kept:
            return noted if noted is not None else -1
    newest = kept[-1] if kept else None
    spark.createDataFrame([(newest,)], "generation long").write.mode("overwrite").parquet(path)
    return newest if newest is not None else -1


def selected(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The selections of all finished micro-batches."""
    return spark.read.schema(schema).parquet(f"{path}/selected").drop("batch_id")


def finish(query: StreamingQuery) -> None:
    """Wait for the available input; a failed stream raises here."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def file_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """One table of a folder as a stream, with the schema of the stored files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).withColumn("_file", F.col("_metadata.file_name"))

"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on. Cluster sizing stays with the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A payload that repeats a key must fail its own rule, not the job.
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    # Rows differ in length by orders of magnitude: batches for Python are bounded by bytes.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); where none is set, as in local
    tests, a folder of the warehouse, which every executor sees too."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Bytes of shuffled rows and of files that a task of a large write takes, about, and partitions its shuffles start with.
PIECE_BYTES, SPLIT_BYTES, PIECES = 16 << 20, 32 << 20, 1024


@contextmanager
def small_pieces(spark: SparkSession) -> Iterator[None]:
    """For one action: tasks are cut by bytes, so what one sorts or aggregates does not grow with the input."""
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PIECE_BYTES),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(
            max(PIECES, int(spark.conf.get("spark.sql.shuffle.partitions")))),
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by a key over as many tasks as a shuffle has, before each row becomes many or costly: a small
    file is one split, whatever its rows grow to."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def sorted_side(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join of sorted keys, for tables that grow with the datasets. Left to itself, Spark broadcasts a
    side by an estimate from the bytes of its files, which sees neither what rows are parsed into nor how well they were
    compressed, and adaptive execution does not take that back: the side would go through the driver whole."""
    return df.hint("merge")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of any executor."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


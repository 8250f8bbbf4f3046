"""Connected components of links, on Spark, without collecting links or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek.llm.store import written


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): each node of ``links`` with a label that its component alone has.

    Contraction: every node takes the smallest of itself and its neighbours as label, edges between
    labels are the next graph, until none is left; then the labels of all turns are chained. With
    ids in no order along the links (hashes) each turn leaves about half of the nodes. Minima are
    aggregated before they are shuffled, so a hub is no hot spot; each turn's tables are written to
    the shared folder."""
    edges = written(
        links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct(), "edges")
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        label = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")), "labels")
        if found is None:
            found = label
        else:
            next_label = label.select(F.col("u").alias("l"), F.col("l").alias("m"))
            found = found.join(next_label, "l", "left").select("u", F.coalesce("m", "l").alias("l"))
        edges = written(
            edges.join(label.withColumnRenamed("l", "lu"), "u")
            .join(label.select(F.col("u").alias("v"), F.col("l").alias("lv")), "v")
            .select(F.col("lu").alias("u"), F.col("lv").alias("v")).where("u <> v").distinct(), "edges")
        if edges.isEmpty():
            return found.select(F.col("u").alias("node"), F.col("l").alias("component"))

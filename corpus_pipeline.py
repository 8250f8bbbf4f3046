"""From raw documents to a training mix: toxic documents go, one document of each group of near
duplicates stays, contaminated documents go, personal data are redacted, sources are mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
they were given. ``run`` writes every stage's result to the shared folder and reads it again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartotek.llm import bitmap, decontamination, mixing, ngram_join, pii, toxicity
from kartotek.llm.registry import table
from kartotek.llm.store import written
from kartotek.session import configure

#: Words of a shingle and similarity in percent from which two documents are near duplicates.
SHINGLE, PERCENT = 5, 80


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine does not reject; it learns from labels that are not held out."""
    return toxicity.remove_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id; rows that repeat an id
    are one document; rows with a null id stay."""
    groups = ngram_join.shingle_components(docs, SHINGLE, PERCENT).where("doc_id IS NOT NULL")
    is_first = F.expr("doc_id = component_id")
    # Ids that do not simply stay; all other texts need no shuffle.
    touched = written(
        groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(is_first).alias("all"), F.max(is_first).alias("kept"))
        .where("n > 1 OR NOT all").select("doc_id", "kept"), "touched")
    clear, rest = bitmap.parted(docs.where("doc_id IS NOT NULL"), touched, "doc_id")
    rest = rest.join(touched, "doc_id", "left").where(F.coalesce("kept", F.lit(True))).dropDuplicates(["doc_id"])
    return clear.unionByName(rest.select(docs.columns)).unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is covered by half or more."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by their kind, and the new length."""
    redacted = pii.redact(docs)
    if "n_chars" in docs.columns:
        length = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        redacted = redacted.withColumn("n_chars", length)
    return redacted.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time a document is drawn."""
    return mixing.draw(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("near duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("personal data", redact_personal_data),
    ("mixing", mix_sources),
]

#: SQL can't express the learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
